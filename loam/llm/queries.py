"""The operators' queries with production parameters, and their oracles where SQL has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import additive, covering, fim, html_text, line_windows, mixcoder, mixing, packing, radix_windows, slots, stream_dedup, tiered, toxic_crf
from loam.llm.shared import table


#: Vocabularies are read where they are installed; their paths are parameters of the operators.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: rows whose vec_id is divisible by 20 against all rows."""
    index, books = additive.build(table(spark, sf_dir, "embeddings"))
    return additive.search(index, books, F.col("vec_id") % 20 == 0)


def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxic_crf.learn(docs, table(spark, sf_dir, "labels"))
    return toxic_crf.score_documents(docs, model).select("doc_id", "held_out", "score", "predicted", F.size("starts").alias("n_spans"))


def op3_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all documents: sequences of at most 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_stateful_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents."""
    found = stream_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


def op5_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all pages."""
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op7_mix_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents: written, then read back from the segments."""
    return mixcoder.read_ids(mixcoder.write_ids(table(spark, sf_dir, "documents"), WORD_BPE))


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents: 40 shards of near equal bytes."""
    rows, _ = slots.shard(table(spark, sf_dir, "documents"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents: links at 4 or fewer differing bits."""
    found = covering.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", covering.hex_fingerprint().alias("fingerprint"), "component_id")


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents; the remaining text as its MD5 and length."""
    return line_windows.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.length("text").alias("n_chars"), F.md5(F.encode("text", "UTF-8")).alias("text_md5")
    )


OP10_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS j FROM d WHERE len(lines) >= 3),
w AS (SELECT doc_id, j, lines[j + 1] || chr(10) || lines[j + 2] || chr(10) || lines[j + 3] AS win FROM p),
r AS (SELECT doc_id, j, row_number() OVER (PARTITION BY win ORDER BY doc_id, j) AS k FROM w
      WHERE regexp_matches(win, '[^\x20\x09-\x0D]')),
gone AS (SELECT DISTINCT doc_id, j + o AS i FROM r, (SELECT unnest(range(3)) AS o) WHERE k > 1),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
rest AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text
         FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(lines) AS INTEGER) AS n_lines, CAST(coalesce(n, 0) AS INTEGER) AS n_removed,
       CAST(length(coalesce(rest.text, '')) AS INTEGER) AS n_chars, md5(coalesce(rest.text, '')) AS text_md5
FROM d LEFT JOIN rest USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op11_tiered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: the 10 best of all documents for each benchmark item."""
    return tiered.search(tiered.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH terms AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
docs AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM docs),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, total GROUP BY term, nd),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score
           FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all documents: bytes of repeated 100-byte strings removed."""
    out = radix_windows.window_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_unit_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents; output and rebuilt text as their SHA-256."""
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
c AS (SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c),
p AS (SELECT *, coalesce(list_aggregate(u[1:a], 'string_agg', ''), '') AS p, coalesce(list_aggregate(u[a + 1:b], 'string_agg', ''), '') AS m,
             coalesce(list_aggregate(u[b + 1:n], 'string_agg', ''), '') AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

QUERIES = {f.__name__: f for f in (op1_additive_ann, op2_crf_toxicity, op3_swap_packing, op4_stateful_dedup, op5_pivotal_mixing, op6_html_text, op7_mix_coder, op8_virtual_slots, op9_covering_simhash, op10_line_windows, op11_tiered_search, op12_radix_windows, op13_unit_fim)}
ORACLE = {"op4_stateful_dedup": OP4_SQL, "op10_line_windows": OP10_SQL, "op11_tiered_search": OP11_SQL, "op13_unit_fim": OP13_SQL}
