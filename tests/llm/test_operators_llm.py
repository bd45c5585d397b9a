"""The ten operators against brute force, round trips and held-out accuracy; edge cases of each."""

import itertools
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.llm import additive, covering, html_text, line_windows, mixcoder, mixing, packing, queries, slots, stream_dedup, toxic_crf
from loam.llm.components import components
from loam.llm.shared import located, stage
from loam.llm.tokens import Encoder

LONG = "word other third fourth. " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, locator string, digest string, fp long, size string, bucket int, vslot string, rank string"
TEXTS = ["a b  c", "a b c", " a b c", "", None, " \t", "x\ny\nz\nw", "q\nx\ny\nz", "x\ny\nz", LONG, LONG, "a b c", "<|endoftext|> don't 12", "É é́ 日本   x"]


def rows(texts=TEXTS, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    return [(i, t, None, None if k % 3 == 0 else f"s{k % 3}", None, "l", "d", 1, "9", 7, "v", "r") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, rows() + [(None, "a b c", *[None] * 10), (3, "", *[None] * 10), (6, "x\ny\nz\nw", *[None] * 10), (-5, "a\tb\rc", *[None] * 10)]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def squeezed(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


# 4: exact deduplication


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, edge, empty, weak):
    digest = (lambda c: (F.crc32(F.encode(c, "UTF-8")) % 3).cast("string")) if weak else None
    docs = [(r.doc_id, squeezed(r.text)) for r in edge.collect()]
    groups = defaultdict(list)
    for i, t in docs:
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    import hashlib

    got = stream_dedup.exact_dedup(edge, digest)
    found = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()), key=repr)
    assert found == sorted(((i, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs), key=repr)
    kept = Counter(r.text_sha256 for r in got.where("kept").collect())
    assert len(kept) == len(groups) and set(kept.values()) == {1}
    assert got.where("kept AND NOT doc_id <=> keep_id").isEmpty()
    assert stream_dedup.exact_dedup(empty, digest).count() == 0


def test_dedup_state_goes_on(spark, tmp_path):
    log, state = f"file://{tmp_path}/log", f"file://{tmp_path}/state"
    one = spark.createDataFrame([(5, "d", None, "l5"), (6, "e", None, "l6")], "doc_id long, digest string, text_sha256 string, locator string")
    one.write.parquet(log)
    stream_dedup.update_state(spark, log, one, state)
    one.limit(1).withColumn("doc_id", F.lit(2).cast("long")).write.mode("append").parquet(log)
    got = {r.digest: (r.keep_id, r.group_size) for r in stream_dedup.update_state(spark, log, one, state).collect()}
    assert got == {"d": (2, 2), "e": (6, 1)} or got == {"d": (5, 1), "e": (2, 2)}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_over_calls(spark, tmp_path, weak):
    """Each call's rows against brute force over the rows of all calls so far; content of earlier calls may be gone."""
    digest = (lambda c: (F.crc32(F.encode(c, "UTF-8")) % 3).cast("string")) if weak else None
    calls = [
        [(10, "a b"), (11, "c"), (12, "d  e"), (13, None), (None, "n")],
        [(5, "a  b"), (20, "c"), (21, "new"), (22, "x"), (3, "n"), (23, "y")],
        [(1, "zz"), (2, "c"), (30, "y"), (31, "y"), (32, "d e")],
    ]
    seen = []
    for data in calls:
        seen += data
        groups = defaultdict(list)
        for i, t in seen:
            groups[squeezed(t)].append(i)
        found = stream_dedup.exact_dedup(frame(spark, rows([t for _, t in data], [i for i, _ in data])), digest, f"file://{tmp_path}/state")
        least = lambda ids: min((i for i in ids if i is not None), default=None)
        want = [(i, least(groups[squeezed(t)]), len(groups[squeezed(t)])) for i, t in data]
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found.collect()), key=repr) == sorted(want, key=repr)
        assert found.where("kept <> (doc_id <=> keep_id)").isEmpty()


# 10: line windows


def brute_lines(docs, width=3):
    """``docs`` in the order of their locators; the first occurrence by (no doc_id, doc_id, locator, line) stays."""
    first, out = {}, []
    for n, (i, t) in enumerate(docs):
        lines = (t or "").split("\n")
        for k in range(len(lines) - width + 1):
            win = tuple(lines[k : k + width])
            if re.search(r"[^\x20\x09-\x0D]", "\n".join(win)):
                place = (i is None, i or 0, n, k)
                first[win] = min(first.get(win, place), place)
    for n, (i, t) in enumerate(docs):
        lines, gone = (t or "").split("\n"), set()
        for k in range(len(lines) - width + 1):
            win = tuple(lines[k : k + width])
            if win in first and (i is None, i or 0, n, k) > first[win]:
                gone.update(range(k, k + width))
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone)))
    return sorted(out, key=repr)


def test_line_windows(spark, edge, empty):
    more = rows(["a\nb\nc\nd\na\nb\nc", "b\nc\nd\ne", "\n\n\n\n", "\n \n\t\n", "a\nb\nc\nd\ne\n", "r\nr\nr\nr\nr", "r\nr\nr"], range(100, 107))
    more += rows(["p\nq\nr\ns"] * 4 + ["0\n1\n2"] * 3 + ["0\n1\n2\n0\n1\n2"], [7, 7, None, None, None, None, None, 9])
    docs = stage(edge.unionByName(frame(spark, more)))
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_windows.line_dedup(docs).collect()), key=repr)
    order = located(docs, "doc_id", "text").orderBy("locator").collect()
    assert got == brute_lines([(r.doc_id, r.text) for r in order])
    left = Counter(r[1] for r in got)
    assert left["p\nq\nr\ns"] == 1 and left["0\n1\n2"] == 1  # rows that repeat, with one doc_id or none
    assert line_windows.line_dedup(empty).count() == 0


# 8: slots


def test_slots(spark, edge, empty):
    got, table = slots.shard(edge, 5)
    data = got.collect()
    assert len(data) == edge.count()
    by = defaultdict(list)
    for r in data:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in edge.collect()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in data), key=repr) == want
    assert {r.version for r in table.collect()} == {1}
    assert slots.shard(empty)[0].count() == 0


def test_shards_have_near_equal_bytes(spark):
    """The whole query on a table: fills against a brute-force greedy assignment of the same slots, one hot doc_id among them."""
    rng = np.random.default_rng(13)
    texts = ["w" * int(n) for n in rng.integers(0, 400, 6000)]
    ids = [7 if k % 3 == 0 else None if k % 30 == 1 else k for k in range(6000)]
    got = slots.shard(frame(spark, rows(texts, ids)), 40)[0].select("doc_id", "size", "vslot", "shard").collect()
    loads, fill = Counter(), Counter()
    for r in got:
        loads[r.vslot] += r.size
        fill[r.shard] += r.size
    brute = [0] * 40
    for v in sorted(loads.values(), reverse=True):
        brute[brute.index(min(brute))] += v
    assert sorted(fill.values()) == sorted(brute) and max(fill.values()) - min(fill.values()) <= max(loads.values())
    assert len({r.vslot for r in got if r.doc_id == 7}) > 500 and max(fill.values()) < 1.02 * sum(brute) / 40


def test_stored_map_is_edited(spark, tmp_path):
    folder = f"file://{tmp_path}/map"
    place = lambda found: {r.doc_id: r.shard for r in found[0].collect()}
    texts = ["w" * (k % 97) for k in range(3000)]
    first = place(slots.shard(frame(spark, rows(texts)), 8, map_dir=folder))
    edited = place(slots.shard(frame(spark, rows([t + "x" for t in texts])), 8, map_dir=folder))
    assert sum(first[k] != edited[k] for k in first) < 30  # an edited text stays where its doc_id is
    found = slots.shard(frame(spark, rows(texts + ["w" * 50] * 600)), 8, map_dir=folder)
    grown = place(found)
    assert sum(edited[k] != grown[k] for k in first) < 0.1 * len(first)
    assert {r.version for r in found[1].collect()} == {3} and slots.newest(spark, folder)[0] == 3
    more = place(slots.shard(frame(spark, rows(texts)), 9, map_dir=folder))
    moved = [k for k in first if more[k] != grown[k]]
    assert set(more.values()) == set(range(9)) and sum(more[k] == 8 for k in moved) > 0.8 * len(moved)


def test_rebalancing_edits_the_map():
    rng = np.random.default_rng(0)
    loads = {k: int(v) for k, v in enumerate(rng.integers(1, 1000, 8192))}
    fill = lambda m: np.bincount([m[s] for s in m], [loads[s] for s in m])
    first = slots.assign(loads, 40)
    assert fill(first).max() - fill(first).min() <= max(loads.values())
    grown = slots.rebalance(loads, first, 41)
    assert set(grown) == set(first) and fill(grown).max() <= 1.05 * fill(grown).mean()
    moved = [s for s in first if first[s] != grown[s]]
    assert sum(grown[s] == 40 for s in moved) > 0.9 * len(moved) and sum(loads[s] for s in moved) < 1.1 * sum(loads.values()) / 41
    fewer = slots.rebalance(loads, first, 39)
    assert set(fewer.values()) == set(range(39)) and fill(fewer).max() <= 1.05 * fill(fewer).mean()


# 5: mixing


def shared_out(spark, data):
    return {r.source: r.target for r in mixing.targets(spark.createDataFrame(data, "source string, source_size long")).collect()}


def test_targets_are_shared_out(spark):
    got = shared_out(spark, [("b", 100), (None, 1), ("a", 1000), ("c", 0)])
    assert math.isclose(sum(got.values()), 1101) and got[None] <= 3 and got["c"] == 0 and got["b"] <= 300
    assert shared_out(spark, []) == {}
    two = shared_out(spark, [("a", 100), ("b", 100)])
    assert math.isclose(two["b"], 2 * two["a"])
    rng = np.random.default_rng(14)
    data = [(f"s{k:03}", int(n)) for k, n in enumerate(rng.pareto(0.7, 200) * 100)]
    left, open_, want, total = 0.0, {s for s, _ in data}, {}, sum(n for _, n in data)
    while open_:  # brute force: close what is above its cap until none is
        left = total - sum(want.values())
        whole = sum(k % 3 + 1 for k, (s, _) in enumerate(data) if s in open_)
        over = {s: 3 * n for k, (s, n) in enumerate(data) if s in open_ and left * (k % 3 + 1) / whole > 3 * n}
        if not over:
            want |= {s: left * (k % 3 + 1) / whole for k, (s, _) in enumerate(data) if s in open_}
            break
        want |= over
        open_ -= set(over)
    got = shared_out(spark, data)
    assert all(math.isclose(got[s], want[s], abs_tol=1e-6) for s in want)


@given(st.lists(st.floats(0, 1), max_size=60), st.integers(0, 99))
@settings(max_examples=60, deadline=None)
def test_pivot_keeps_the_sum(p, seed):
    out = mixing.pivot(np.array(p), np.random.default_rng(seed))
    assert abs(out.sum() - sum(p)) < 1e-6 and ((out > 1e-6) & (out < 1 - 1e-6)).sum() <= 1
    assert out.min(initial=0) >= -1e-9 and out.max(initial=0) <= 1 + 1e-9


def test_pivot_is_unbiased():
    p = np.array([0.2, 0.5, 0.9, 0.7, 0.1, 0.6])
    mean = np.mean([mixing.pivot(p, np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def test_mix(spark, edge, empty):
    rng = np.random.default_rng(1)
    docs = frame(spark, [(k, "w " * int(rng.integers(1, 300)), None, ["a", "b", "c", None][k % 4 if k % 2 else 0], *[None] * 8) for k in range(900)]).unionByName(edge)
    got = mixing.mix(docs, bucket=50).toPandas()
    assert len(got) == docs.count() and (got["taken"] <= 3 * got["size"]).all() and (got["taken"] % got["size"].where(got["size"] > 0, 1) == 0).all()
    for _, g in got.groupby("source", dropna=False):
        assert g["size"].sum() == g["source_size"].iloc[0]
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= max(300, 0.02 * g["target"].iloc[0])
    again = mixing.mix(docs.repartition(7), bucket=50).toPandas()
    key = lambda d: sorted(zip(d["doc_id"].fillna(-1), d["size"], d["taken"], strict=True))
    assert key(got) == key(again)
    assert mixing.mix(empty).count() == 0


def test_every_document_is_taken_with_its_probability(spark):
    """600 sources that are alike, each with one very long document: frequencies over them, by weight."""
    sizes = [10] * 38 + [200, 2000, 5000]
    docs = [(1000 * s + k, "w " * n, None, f"s{s:04}", *[None] * 8) for s in range(600) for k, n in enumerate(sizes)]
    got = mixing.mix(frame(spark, docs)).toPandas()
    got["p"] = got["target"] / got["source_size"]
    for p, g in got.groupby(got["p"].round(9)):
        n = g["source"].nunique()
        assert n == 200
        for size, h in g.groupby("size"):
            slack = 4 * math.sqrt((p % 1) * (1 - p % 1) / len(h))
            assert abs(h["copies"].mean() - p) <= slack, (p, size)
    assert abs(got["taken"].sum() / got["size"].sum() - 1) < 0.05


@pytest.mark.parametrize("sf, most, mean, bucket", [("0.01", 0.05, 0.01, 2000), ("0.01", 0.05, 0.01, 20), ("0.1", 0.01, 0.001, 2000)])
def test_taken_words_come_near_every_target(spark, sf, most, mean, bucket):
    """Sources of 50 documents (sf0.01) can't all come as near as those of 500, whatever is drawn."""
    got = mixing.mix(bucket=bucket, docs=spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet"))
    per = got.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n"))
    off = {r.source: (round(r.taken / r.target - 1, 4), r.n) for r in per.collect() if r.target}
    assert len(off) > 5 and max(abs(x) for x, _ in off.values()) <= most and sum(abs(x) for x, _ in off.values()) <= mean * len(off), off


def test_rows_that_repeat_do_not_share_a_bucket(spark):
    sized = spark.range(4000).select(F.col("id").cast("string").alias("locator"), F.lit("s").alias("source"), F.lit(5).cast("long").alias("size"), F.lit(99).cast("long").alias("key"))
    per = [r[1] for r in mixing._buckets(sized, 100).groupBy("bucket").count().collect()]
    assert sum(per) == 4000 and max(per) < 160 and len(per) == 40


# 3: packing


def test_best_fit_and_search():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 300):
        sizes = rng.integers(1, 101, n)
        bins = packing.pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(n)) and all(sizes[b].sum() <= 100 for b in bins)
        assert len(bins) <= math.ceil(sizes.sum() / 100) * 1.1 + 1
    # Best fit needs three bins here; exchanges find the two that exist.
    sizes = np.array([6, 5, 5, 4])
    search = packing._Search(sizes, [[0], [1, 2], [3]], 10)
    assert sorted(map(sorted, search.run())) == [[0, 3], [1, 2]]
    sizes = np.array([55, 45, 30, 30, 40])
    assert len(packing._Search(sizes, [[0, 2], [1, 3], [4]], 100).run()) == 2


def brute_bins(sizes, capacity):
    """Least bins by trying every placement."""
    best = len(sizes)

    def place(k, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(sizes):
            best = len(fills)
            return
        for j in range(len(fills)):
            if fills[j] + sizes[k] <= capacity and fills[j] not in fills[:j]:
                place(k + 1, [*fills[:j], fills[j] + sizes[k], *fills[j + 1 :]])
        place(k + 1, [*fills, sizes[k]])

    place(0, [])
    return best


def test_packing_near_the_optimum():
    rng = np.random.default_rng(15)
    excess = 0
    for _ in range(60):
        sizes = rng.integers(1, 41, int(rng.integers(1, 11)))
        least, got = packing.lower_bound(sizes, 40), len(packing.pack(sizes, 40))
        want = brute_bins(sorted(sizes.tolist(), reverse=True), 40)
        assert least <= want <= got
        excess += got - want
    assert excess <= 1
    # Best fit decreasing misses the optimum of such triplets by many bins; exchanges find most of them.
    sizes = []
    for _ in range(200):
        a = int(rng.integers(260, 480))
        b = int(rng.integers(260, 1000 - a - 250))
        sizes += [a, b, 1000 - a - b]
    sizes = np.array(sizes)
    fit, found = len(packing.best_fit(sizes.tolist(), 1000)), packing.pack(sizes, 1000)
    assert len(found) < fit and sorted(i for b in found for i in b) == list(range(600))
    search = packing._Search(sizes, found, 1000)  # no underfull bin has an exchange left, or the bound is met
    assert len(found) == packing.lower_bound(sizes, 1000) or not any(search._exchange(b) for b in range(len(found)) if search.fill[b] < 1000)
    alike = np.full(30_000, 1100)
    assert packing.lower_bound(alike, 2048) == 30_000 == len(packing.pack(alike, 2048))


def test_residues_are_bounded():
    import pandas as pd

    n = 3000
    group = pd.DataFrame({"doc_id": range(n), "piece": 0, "start": 0, "length": 1100, "ids_crc32": 0, "part": 0, "row": range(n), "bucket": 3})
    out = packing._level(0, False, 2048, 100)((3,), group)
    assert out["open"].sum() == 100 and out["sequence_id"].nunique() == n
    assert not packing._level(0, True, 2048, 100)((3,), group)["open"].any()


def test_pack_documents(spark, edge, empty):
    got = packing.pack_documents(edge, queries.BYTE_BPE, group=7).collect()
    enc = Encoder(queries.BYTE_BPE).lib
    want = Counter()
    for r in edge.collect():
        ids = np.array([*enc.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r.doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids))))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for v in seqs.values():
        v.sort()
        assert [o for o, _ in v] == [0, *itertools.accumulate(n for _, n in v)][:-1] and sum(n for _, n in v) <= 2048
    assert len(seqs) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(2048) == [(0, 2048)] and packing.cut(1) == [(0, 1)]
    assert packing.pack_documents(empty, queries.BYTE_BPE).count() == 0


# 7: coder


@given(st.lists(st.integers(0, 65535), max_size=700), st.integers(1, 64))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_coder_round_trip(ids, block):
    ids = np.array(ids, "<u4")
    data = mixcoder.pack_segment([3], [len(ids)], ids, 11, block, 8)
    names, lengths, back, start = mixcoder.read_segment(data, 8)
    assert (names, lengths.tolist(), start) == ([3], [len(ids)], 11) and np.array_equal(back, ids)


def test_coder_compresses_and_finds_damage():
    ids = np.tile(np.arange(50, dtype="<u4") * 7, 400)
    data = mixcoder.pack_segment([1], [len(ids)], ids, 0)
    assert len(data) < len(ids) // 2
    for at in (8, 40, len(data) - 5):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            mixcoder.read_segment(bytes(bad))
    with pytest.raises(ValueError):
        mixcoder.pack_segment([1], [1], np.array([70000], "<u4"), 0)


def adaptive_order0_bits(block):
    """Cost of an adaptive order-0 coder that starts afresh: counts so far, an escape by distinct ids, 16 bits for a new id."""
    seen, bits = Counter(), 0.0
    for n, x in enumerate(block.tolist()):
        total = n + len(seen)
        bits += math.log2(total / seen[x]) if seen[x] else (math.log2(total / len(seen)) if seen else 0) + 16
        seen[x] += 1
    return bits


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_coder_beats_simpler_coders_on_the_same_blocks():
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").sort_by("doc_id")
    ids = Encoder(queries.WORD_BPE).encode(docs["text"])[0].astype(np.uint16)
    blocks = ids[: len(ids) // mixcoder.BLOCK * mixcoder.BLOCK].reshape(-1, mixcoder.BLOCK)
    own = sum(32 * len(w) for w in mixcoder.encode_blocks(blocks))
    assert own < sum(8 * len(zlib.compress(b.tobytes(), 9)) for b in blocks)
    assert own < sum(map(adaptive_order0_bits, blocks))


def test_blocks_are_independent():
    rng = np.random.default_rng(12)
    blocks = np.minimum(rng.geometric(0.01, (6, 900)), 65535).astype(np.uint16)
    blocks[3] = np.arange(900) * 70
    together = mixcoder.encode_blocks(blocks)
    for k, words in enumerate(together):
        assert np.array_equal(mixcoder.encode_blocks(blocks[k : k + 1])[0], words)
        assert np.array_equal(mixcoder.decode_blocks([words], 900)[0], blocks[k])


def test_files_hold_the_segments(spark, edge, tmp_path):
    table = mixcoder.write_ids(edge, queries.WORD_BPE, block=64, lanes=4, folder=f"file://{tmp_path}/ids").collect()
    files = {p: p.stat().st_size for p in (tmp_path / "ids").iterdir()}
    assert files and {str(p) for p in files} == {r.path for r in table} and sum(files.values()) == sum(r.bytes for r in table)


def test_write_and_read_ids(spark, edge, empty):
    got = mixcoder.read_ids(mixcoder.write_ids(edge, queries.WORD_BPE, block=64, lanes=4)).collect()
    enc = Encoder(queries.WORD_BPE).lib
    docs = sorted(((r.doc_id, r.text) for r in edge.collect()), key=lambda d: (d[0] is None, d[0] or 0, d[1] is not None, d[1] or ""))
    want, start = [], 0
    for i, t in docs:
        ids = np.array([*enc.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda x: x[1]) == want
    assert mixcoder.read_ids(mixcoder.write_ids(empty, queries.WORD_BPE)).count() == 0


@pytest.mark.parametrize("path", [queries.BYTE_BPE, queries.WORD_BPE])
def test_encoder_is_exact(path):
    import pyarrow as pa

    e = Encoder(path, cache=50)

    @given(st.lists(st.text(st.sampled_from("ab Z'st\n\t 12.!é́ 　ßİ<|>\x1c日"), max_size=40), max_size=8))
    @settings(max_examples=150, deadline=None)
    def run(texts):
        ids, at = e.encode(pa.array(texts, pa.string()))
        for k, t in enumerate(texts):
            assert ids[at[k] : at[k + 1]].tolist() == e.lib.encode(t, add_special_tokens=False).ids, t

    run()


# 9: SimHash


def naive_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, radius=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [least.get(find(k)) for k in range(len(fps))]


def test_masks_cover_the_radius():
    family = covering.masks()
    assert len(family) == 31
    rng = np.random.default_rng(3)
    for _ in range(3000):
        bits = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(bits & m == 0 for m in family)


def test_near_duplicates(spark, edge, empty):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today "
    texts = [base * 6 + "w" * k for k in range(6)] + [base * 6, base.upper() * 6]
    docs = edge.unionByName(frame(spark, rows(texts, range(200, 208))))
    data = docs.collect()
    fps = [naive_fingerprint(r.text) for r in data]
    want = sorted(((r.doc_id, f"{f:016x}", c) for r, f, c in zip(data, fps, brute_components(fps, [r.doc_id for r in data]), strict=True)), key=repr)
    found = covering.near_duplicates(docs)
    assert sorted(((r.doc_id, r.h, r.component_id) for r in found.select("doc_id", covering.hex_fingerprint().alias("h"), "component_id").collect()), key=repr) == want
    reps = covering.representatives(found).collect()
    assert sorted(r.doc_id for r in reps) == sorted({c for _, _, c in want})
    assert covering.near_duplicates(empty).count() == 0


def test_large_buckets_lose_no_link(spark):
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 1 << 62))
    fps = {base}
    while len(fps) < 300:
        x = int(rng.choice(list(fps)))
        for b in rng.choice(64, int(rng.integers(1, 7)), replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = covering.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), block=8).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in links)
    roots = {r.node: r.root for r in components(spark.createDataFrame([(r.a, r.b) for r in links], "a long, b long")).collect()}
    want = brute_components(fps, signed)
    assert [roots.get(x, x) for x in signed] == want


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(7777, 7777)]
    rng = np.random.default_rng(5)
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1100)}


# 2: toxicity


def test_marginals_like_enumeration():
    rng = np.random.default_rng(6)
    for _ in range(20):
        n, size = int(rng.integers(1, 7)), 3
        model = toxic_crf.Model({}, rng.normal(size=size), rng.normal(size=(2, 2)), rng.normal(size=2), np.zeros(4))
        ids = rng.integers(0, size, n)
        weight = {}
        for tags in itertools.product((0, 1), repeat=n):
            s = model.start[tags[0]] + sum(model.emit[e] for e, y in zip(ids, tags, strict=True) if y)
            weight[tags] = math.exp(s + sum(model.move[a, b] for a, b in itertools.pairwise(tags)))
        total = sum(weight.values())
        at = [k for k in range(n) if ids[k]]
        want = [sum(w for t, w in weight.items() if t[k]) / total for k in at]
        assert np.allclose(toxic_crf.marginals(model, at, [int(ids[k]) for k in at], n), want)


def test_toxicity(spark, edge, empty):
    rng = np.random.default_rng(7)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    data, labels = [], []
    for k in range(500):
        text = list(rng.choice(words, 40))
        toxic = k % 5 == 0
        if toxic:
            for at in rng.choice(40, 3, replace=False):
                text[at] = str(rng.choice(["Vileword", "nastything"]))
        data.append((k, " ".join(text), *[None] * 10))
        labels.append((k, 1, int(toxic)))
    docs, marked = frame(spark, data), spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxic_crf.learn(docs, marked)
    got = {r.doc_id: r for r in toxic_crf.score_documents(docs, model).collect()}
    held = [k for k in got if got[k].held_out]
    assert held == sorted(held, key=lambda k: k) or held
    assert {k for k in got if zlib.crc32(str(k).encode()) % 4 == 2} == set(held)
    assert all(got[k].predicted == (k % 5 == 0) for k in held)
    one = got[0]
    assert all(data[0][1][a:b].lower().split()[0] in ("vileword", "nastything") for a, b in zip(one.starts, one.ends, strict=True)) and one.starts
    assert {r.doc_id for r in toxic_crf.without_toxic(docs, model).collect()} == {k for k in got if not got[k].predicted}
    scored = toxic_crf.score_documents(edge, model).collect()
    assert len(scored) == edge.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxic_crf.without_toxic(edge, model).columns == edge.columns
    assert toxic_crf.score_documents(empty, model).count() == 0
    none = toxic_crf.learn(docs, marked.limit(0))
    assert none is None and {r.score for r in toxic_crf.score_documents(edge, none).collect()} == {0.0}


# 6: HTML


def test_html():
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><header>Site</header><nav><ul><li><a href=x>Menu</a></ul></nav>"
        "<div class='ad'>Buy</div><article><header><h1>Head &amp; more</h1></header><p>One<br>two&nbsp;  three<p><b>Four</b>\n five</p><script>x</script><form>mail</form>"
        "<div class='comments'><p>Reader</p></div><p>.</p></article><aside>Side</aside><footer>&copy;</footer>"
    )
    assert html_text.extract(page) == ["Head & more", "One two three", "Four five", "."]
    assert html_text.extract(None) == html_text.extract("") == html_text.extract("<p> </p><nav>x</nav>") == []
    assert html_text.extract("<div class=ad>Buy<article><p>Text</article>") == ["Text"]
    long = "word " * 50
    assert html_text.extract(f"<div><a>x</a><a>y</a><a>z</a></div><p>{long}</p><p>{long}</p><div><a>q</a><i></i><b></b></div>") == [long.strip()] * 2
    assert html_text.extract("<p>a &lt;b&gt; <unclosed") == ["a <b>"] or html_text.extract("<p>a &lt;b&gt; <unclosed")[0].startswith("a <b>")


def sentences(n, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join("word" + "x" * int(k) for k in rng.integers(0, 6, int(m))) + "." for m in rng.integers(18, 50, n)]


def test_html_without_article_elements():
    """Ratios, smoothing and clusters find the post between unmarked boxes."""
    post = sentences(6)
    links = "".join(f"<li><a href=/{k}>Page {k}</a></li>" for k in range(12))
    readers = "".join(f"<li><a href=/u{k}><img src=a.png></a> <b>User {k}</b> <i>today</i> <span>nice <em>one</em></span> <a href=#>Reply</a></li>" for k in range(15))
    body = f"<h1>Title</h1><p>{post[0]}</p><p>{post[1]}</p><h2>Part</h2><p>{post[2]}<br>{post[3]}</p><p>Short.</p><p>{post[4]}</p><p>{post[5]}</p>"
    want = ["Title", post[0], post[1], "Part", f"{post[2]} {post[3]}", "Short.", post[4], post[5]]
    for shape in (
        f"<body><ul>{links}</ul><div><div class=x>{body}</div><ul>{readers}</ul></div><div>Imprint <a href=/>x</a></div>",
        f"<div><div>{links}</div><div id=content>{body}</div></div><div>{readers}</div><p>&copy; 2020</p>",
        f"<table><tr><td>{links}</td><td>{body}</td></tr></table>",
        f"<body><div class='sidebar left'>{sentences(3, 5)[0]}</div><div class='post related-work'>{body}</div><div class=ad>{post[0]}</div>",
    ):
        assert html_text.extract(shape) == want, shape[:60]


def test_html_with_article_elements():
    one, two, other, reader = sentences(4, 1)
    assert html_text.extract(f"<article><p>{one}</p></article><p>{other}</p><article><p>{two}</p><p>ok</p></article>") == [one, two, "ok"]
    assert html_text.extract(f"<div><p>{other}</p></div><main><h1>H</h1><section class='related-work'><h2>Related work</h2><p>{one}</p></section><div class='search results'><p>{two}</p></div></main>") == ["H", "Related work", one, two]
    menu = "".join(f"<li><a href=/{k}>More {k}</a></li>" for k in range(5))
    assert html_text.extract(f"<article><p>{one}</p><ul>{menu}</ul><p>See <a href=x>this</a>.</p><div class=comments><p>{reader}</p></div></article>") == [one, "See this."]
    assert html_text.extract(f"<article><p>{one}</p><div class='cookie-notice'>{two}</div><span class=ad>{two}</span> end</article>") == [one, "end"]


def test_html_of_any_kind_does_not_crash():
    for odd in ("<![foo[x]]>text", "<![ 5", "<![if !IE]><p>a</p><![endif]>", "<!", "<!-", "<!--x", "<?php", "</", "<a <b", "<![CDATA[<p>x</p>]]>", "&#xffffffff; &#0; \ud800".encode("utf-8", "replace").decode()):
        for page in (odd, f"<article><p>{odd}</p></article>", f"<p>{odd}"):
            assert isinstance(html_text.extract(page), list)
    assert html_text.extract("<article><p>a<![foo[x]]>b</p></article>")

    @given(st.lists(st.sampled_from(["<", ">", "!", "[", "]", "-", "/", "p", "article", "<p>", "</div>", "<div class='ad'>", "<![", "&#x", "&amp", ";", "x y", '"', "=", "<script>", "</script>", "<li>", "\n", "\x00", "<a href=", "<!--", "-->", "?"]), max_size=30))
    @settings(max_examples=400, deadline=None)
    def run(parts):
        assert all(t == t.strip() and t for t in html_text.extract("".join(parts)))

    run()
    assert html_text.extract("<b>x</i>" * 30_000)  # unclosed and unopened tags, in linear time


def test_html_frame(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    got = html_text.extract_pages(spark.createDataFrame([(1, "u", "<p>a</p>", "t", "n"), (None, None, None, None, None), (1, "u", "<p>a</p>", "t", "n"), (2, "u", f"<p>{LONG}</p>", None, None)], schema))
    assert sorted(((r.page_id, r.n_chars) for r in got.collect()), key=repr) == [(1, 1), (1, 1), (2, len(LONG.strip())), (None, 0)]
    assert html_text.extract_pages(spark.createDataFrame([], schema)).count() == 0


# 1: additive quantisation


def test_beam_is_no_worse_than_greedy():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 16))
    books = additive.fit(x, 4, 16, rounds=1)
    err = lambda beam: ((x - additive.rebuilt(books, additive.encode(books, x, beam))) ** 2).sum()
    assert err(8) <= err(1) < (x**2).sum()


def test_search(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1200, 24)).astype(np.float32)
    x[300:400] = x[300]  # one vector a hundred times
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [1.0] * 23), (5060, [float("nan")] + [1.0] * 23), (5080, [None] + [1.0] * 23), (5100, [float("inf")] + [1.0] * 23), (None, [1.0] * 24)]
    data = [(k, v.tolist(), 1, "c", 2) for k, v in enumerate(x)] + [(i, v, 1, "c", 2) for i, v in odd] + [(7, x[7].tolist(), 1, "c", 2)]
    frame_ = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, codes string, block int")
    index, books = additive.build(frame_)
    assert index.count() == 1200
    got = defaultdict(list)
    for r in additive.search(index, books, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    y, hit = x.astype(np.float64), 0
    assert set(got) == set(range(0, 1200, 20))
    for q, found in got.items():
        scores = y @ y[q]
        scores[q] = -np.inf
        want = np.lexsort((np.arange(1200), -scores))[:20]
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        assert np.allclose([f[2] for f in found], [scores[f[1]] for f in found], rtol=1e-12)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hit += len(set(want.tolist()) & {f[1] for f in found})
        if 300 <= q < 400:
            assert [f[1] for f in found] == [k for k in range(300, 322) if k != q][:20]
    assert hit / (20 * len(got)) >= 0.9
    small, books = additive.build(frame_.where("vec_id < 5"))
    assert additive.search(small, books, F.col("vec_id") % 20 == 0).count() == 4
    for none in (frame_.limit(0), frame_.where("vec_id = 5020")):
        index, books = additive.build(none)
        assert additive.search(index, books, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/check_l"), reason="no test tables")
def test_recall_on_a_large_table(spark):
    """Against brute force on over 50,000 rows, of which at most 2 % are reranked for a query."""
    table = spark.read.parquet("/root/testdata/check_l/embeddings.parquet")
    index, books = additive.build(table)
    n = index.count()
    assert n >= 50_000 and additive.RERANK <= 0.02 * n + 1
    found = additive.search(index, books, F.col("vec_id") % 2000 == 0).collect()
    ids, vectors = zip(*((r.vec_id, r.embedding) for r in index.select("vec_id", "embedding").collect()), strict=True)
    ids, x = np.array(ids), np.array(vectors, np.float64)
    got, hit = defaultdict(set), 0
    for r in found:
        got[r.query_id].add(r.vec_id)
    for q, near in got.items():
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        hit += len(near & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert len(got) >= 20 and hit / (20 * len(got)) >= 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_toxicity_held_out(spark, sf):
    """Held-out accuracy on the driver's labels: few clean documents are rejected."""
    sf = f"/root/testdata/{sf}"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [(r.predicted, labels[r.doc_id]) for r in queries.op2_crf_toxicity(spark, sf).where("held_out").collect() if r.doc_id in labels]
    caught = sum(p and y for p, y in found)
    assert caught / sum(y for _, y in found) > 0.9 and caught / sum(p for p, _ in found) > 0.95


def test_field_expectations_like_enumeration():
    """Expected tags, moves and log Z of the fit against every tag sequence."""
    rng = np.random.default_rng(16)
    sample = toxic_crf._Sample(["aa bb aa cc", "bb cc", "cc"], [1, 0, 0])
    emit, start, move = rng.normal(size=sample.tokens.shape), 0.3, rng.normal(size=3)
    tag, moved, first, logs = toxic_crf._expect(sample, emit, start, move)
    for n in range(sample.tokens.shape[1]):
        m = int((sample.tokens[:, n] < sample.count).sum())
        weight = {}
        for tags in itertools.product((0, 1), repeat=m):
            s = tags[0] * start + sum(emit[i, n] for i in range(m) if tags[i])
            weight[tags] = math.exp(s + sum({(0, 0): 0, (0, 1): move[0], (1, 0): move[1], (1, 1): move[2]}[p] for p in itertools.pairwise(tags)))
        total = sum(weight.values())
        assert np.allclose(logs[n], math.log(total))
        assert np.allclose(tag[:m, n], [sum(w for t, w in weight.items() if t[i]) / total for i in range(m)])
        for k, pair in enumerate(((0, 1), (1, 0), (1, 1))):
            assert np.allclose(moved[k, n], sum(w * sum(p == pair for p in itertools.pairwise(t)) for t, w in weight.items()) / total)
        assert np.allclose(first[n], sum(w for t, w in weight.items() if t[0]) / total)


def test_neighbours_and_affixes_count():
    model = toxic_crf.Model({"p:vil": (9.0, 0.0, 0.0), "w:very": (0.0, 4.0, 0.0), "s:hole": (5.0, 0.0, 0.0)}, np.array([-6.0]), np.zeros((2, 2)), np.zeros(2), np.zeros(4))
    read = lambda t: dict(zip(*toxic_crf.read(model, toxic_crf._Entries(model), t)[:2], strict=True))
    alone, after = read("a bighole here"), read("a very bighole here")
    assert after[2] > alone[1] and read("vilest words")[0] > 0.9
    text = "fine words " * 500 + "Vilely said"
    score, starts, ends = toxic_crf.tag(model, text)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == ["Vilely"]


def test_repeated_labelled_rows_are_one(spark):
    """A doc_id that very many rows share gives the sample one row."""
    docs = [(k, f"plain text number w{k % 50} here and there" + (" vileword" if k % 4 == 0 else ""), *[None] * 10) for k in range(400)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    once = toxic_crf.learn(frame(spark, docs), labels)
    often = toxic_crf.learn(frame(spark, docs + [docs[1]] * 3000), labels)
    assert once.weights == often.weights and any(k.startswith("w:vileword") for k in once.weights)
