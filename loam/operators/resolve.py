"""Entity resolution of company names: keys, fuzzy links, clusters."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions import fixed
from loam.functions.text import drop_words, replace_words
from loam.operators import fuzzy
from loam.operators.relational import grown, stored, surrogate_ids

#: Keys of a block; two blocks meet in one group.
BLOCK = 1024
#: Where all names of one pattern meet: about so many blocks, at most so many times as large, and how many such pairs are as much work as one by an element.
BLOCKS, WIDER, CHEAPER = 16, 8, 8


def matching_key(name: Column) -> Column:
    """ER-02, ER-03: brand rewrites, then sector words stripped; the name itself if nothing is left."""
    return drop_words(replace_words(name, fixed.BRANDS), fixed.SECTOR_WORDS)


def token_set_ratio(a: str, b: str) -> float:
    """ER-04: similarity of token sets, 0 to 100."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = x & y, x - y, y - x
    if both and (not only_a or not only_b):
        return 100.0
    common = " ".join(sorted(both))
    left = " ".join(filter(None, (common, " ".join(sorted(only_a)))))
    right = " ".join(filter(None, (common, " ".join(sorted(only_b)))))
    scores = [fuzzy.indel(left, right)]
    if common:
        scores += [fuzzy.indel(common, left), fuzzy.indel(common, right)]
    return max(scores)


#: What separates tokens: the white space of Unicode and the four ASCII separators.
_BREAKS = "(?U)[\\s\\x1C-\\x1F]+"


def _slots(df: DataFrame) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _token_keys(names: DataFrame, key: str) -> DataFrame:
    """k, n (its length), tokens (sorted set), size (length of the tokens joined), grams (tagged pairs of characters).

    The padded pairs of characters of the joined tokens are those of each token, whatever
    their order; a repeated pair carries its number, so sets stand for multisets.
    """
    # A named count of tasks: names are few bytes, which one task would get, and much work.
    keys = names.select(F.col(key).alias("k")).where("k IS NOT NULL AND k <> ''").repartition(_slots(names), "k").distinct()
    tokens = F.array_sort(F.array_distinct(F.filter(F.split("k", _BREAKS), lambda x: x != "")))
    pairs = lambda x: F.transform(F.sequence(F.lit(1), F.length(x) + 1), lambda i: F.substring(F.concat(F.lit(" "), x, F.lit(" ")), i, F.lit(2)))
    return (
        keys.select("k", F.length("k").alias("n"), tokens.alias("tokens")).where(F.size("tokens") > 0)
        .withColumn("size", F.length(F.array_join("tokens", " ")))
        .withColumn("pairs", F.array_sort(F.flatten(F.transform("tokens", pairs))))
        .withColumn("grams", F.transform("pairs", lambda g, i: F.concat(g, (i + 1 - F.array_position("pairs", g)).cast("string"))))
        .drop("pairs")
    )


def _overlap(a: Column, b: Column, e: float) -> Column:
    """How many pairs of characters keys of joined lengths ``a`` and ``b`` share at least, if they are within ``e``.

    An even number of insertions and deletions lies between lengths whose sum is even, and an
    odd number else; each takes away one and a half pairs on average.
    """
    both = (a + b).cast("int")
    most = F.floor(both * e + 1e-9).cast("int")
    return F.floor((both + 2 - 3 * (most - F.pmod(most - both, F.lit(2)))) / 2).cast("int")


def _listed(keys: DataFrame, share: float, e: float) -> DataFrame:
    """k, n, size, tokens (sorted), picked (a flag for each), rare: each key's tokens and its rarest pairs of characters.

    Elements are ordered by the number of keys that hold them. A token is picked unless the
    tokens before it make up more than a side may lack; of the pairs only those are listed that
    one of every shared set of the least size must be among.
    """
    tagged = F.concat(F.transform("tokens", lambda x: F.concat(F.lit("t"), x)), F.transform("grams", lambda x: F.concat(F.lit("g"), x)))
    each = keys.select("k", F.explode(tagged).alias("element"))
    often = each.groupBy("element").agg(F.count(F.lit(1)).alias("often"))
    lists = each.join(grown(often), "element").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("all"))
    of = lambda kind: F.transform(F.filter("all", lambda x: F.substring(x["element"], 1, 1) == kind), lambda x: F.substr(x["element"], F.lit(2)))
    # The least overlap with any partner, by the lengths that there are.
    sizes = keys.select("size").distinct()
    others = sizes.select(F.col("size").alias("other"))
    near = sizes.join(others, F.expr(f"least(size, other) >= {share} * greatest(size, other) - 1e-9"))
    least = near.groupBy("size").agg(F.min(_overlap(F.col("size"), F.col("other"), e)).alias("least"))
    both = keys.select("k", "n", "size", "tokens").join(grown(lists.select("k", of("t").alias("rarest"), of("g").alias("grams"))), "k").join(least, "size")
    before = lambda i: F.aggregate(F.slice("rarest", F.lit(1), i), F.lit(0), lambda s, x: s + F.length(x))
    chosen = F.filter("rarest", lambda x, i: before(i) <= (1 - share) * F.col("size") + 1)
    both = both.withColumn("chosen", chosen).withColumn("rare", F.slice("grams", F.lit(1), F.greatest(F.size("grams") - F.col("least") + 1, F.lit(1)).cast("int")))
    return both.select("k", "n", "size", "tokens", F.transform("tokens", lambda x: F.array_contains("chosen", x)).alias("picked"), "rare")


def _everyone(held: DataFrame, often: DataFrame) -> tuple[DataFrame | None, int]:
    """Keys that hold one of the elements in ``often``, and their number, if all of their pairs are less work than those of the elements."""
    pairs = float(often.agg(F.coalesce(F.sum(F.col("many").cast("double") * F.col("many")), F.lit(0.0))).first()[0])
    if not pairs:
        return None, 0
    keys = stored(held.select("k", "kind", "element").join(grown(often.select("kind", "element")), ["kind", "element"]).select("k").distinct())
    many = keys.count()
    return (keys, many) if float(many) * many <= CHEAPER * pairs else (None, 0)


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` once for each of their elements that others hold and each pair of its blocks.

    ``kind`` and ``element`` name what is shared, ``at`` is its place in tokens or rare,
    (deal, i, j) the group, ``own`` the row's block. Elements of one block share groups.

    Names of one pattern hold the same few pairs of characters, and would meet by each of them.
    Where that is more work than to let all such names meet once, they do (kind "a"), in larger
    blocks; ``all`` marks them, and those pairs of characters are dealt only where a name too long for that holds them.
    """
    as_element = lambda kind: lambda x, i: F.struct(F.lit(kind).alias("kind"), x.alias("element"), i.alias("at"))
    held = rows.withColumn("x", F.explode(F.concat(F.transform("tokens", as_element("t")), F.transform("rare", as_element("g"))))).select("k", "size", "picked", "x.*")
    long = F.col("size") >= fuzzy.MOST
    ready = F.max((F.col("kind") == "g") | F.element_at("picked", F.col("at") + 1))
    sized = held.groupBy("kind", "element").agg(F.count(F.lit(1)).alias("many"), ready.alias("ready"), F.max(long).alias("long")).where("many > 1 AND ready")
    sized = stored(sized.select("kind", "element", "many", "long", F.ceil(F.col("many") / F.lit(block)).cast("int").alias("blocks")))
    often = (F.col("kind") == "g") & (F.col("blocks") > 1)
    met, many = _everyone(held.where(~long), sized.where(often))
    if met is None:
        rows = rows.withColumn("all", F.lit(False))
    else:
        sized = sized.where(~often | F.col("long"))
        rows = stored(rows.join(grown(met.withColumn("all", F.lit(True))), "k", "left").withColumn("all", F.coalesce("all", F.lit(False))))
    one = F.col("blocks") == 1
    small, pairs = sized.agg(F.coalesce(F.sum(F.when(one, F.col("many"))), F.lit(0)), F.coalesce(F.sum(F.when(~one, F.col("blocks") * (F.col("blocks") + 1) / 2)), F.lit(0))).first()
    deals = -(-int(small) // block) + 1
    dealt = held.drop("size", "picked").join(grown(sized.drop("long")), ["kind", "element"]).join(grown(rows), "k").withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    deal = F.when(one, F.pmod(F.xxhash64("kind", "element"), F.lit(deals)).cast("string")).otherwise(F.concat("kind", "element"))
    dealt = dealt.withColumn("deal", deal)
    if met is not None:
        blocks = -(-many // max(block, min(WIDER * block, many // BLOCKS)))
        pairs += blocks * (blocks + 1) // 2
        wide = rows.where("all").withColumn("rare", F.array().cast("array<string>")).withColumn("own", F.pmod(F.xxhash64("k"), F.lit(blocks)).cast("int"))
        wide = wide.select("*", F.lit("a").alias("kind"), F.lit("").alias("element"), F.lit(0).alias("at"), F.lit(many).cast("long").alias("many"), F.lit(blocks).alias("blocks"), F.lit("a").alias("deal"))
        dealt = dealt.unionByName(wide)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("many", "blocks", "other")
    # A named count of tasks: they are long by their pairs, not by the bytes that Spark judges them by.
    tasks = min(deals + int(pairs), 4 * _slots(rows))
    return dealt.repartition(tasks, "deal", "i", "j")


def fuzzy_pairs(names: DataFrame, key: str = "key", score: int = fixed.FUZZY_SCORE, ratio: float = fixed.LENGTH_RATIO, block: int = BLOCK) -> DataFrame:
    """J-08, ER-04: (a, b, score) for pairs of distinct keys, a < b, by the similarity of their token sets.

    With e = 1 - score / 100, a pair scores by one of two ways. Either the common tokens make
    up a share of at least (1 - e) / (1 + e) of one side: then, of any of its tokens that make
    up more than the rest, one is common. Or the joined tokens are within e of each other in
    insertions and deletions; each of those changes at most two pairs of characters, so both
    sides share at least so many of them (``_overlap``), and thus one among the rarest few.

    Keys meet in blocks by what they share and are weighed there (``fuzzy.pairs_of_block``), each pair at
    the first thing it shares, so that no pair is shuffled. Scores are rounded half up, so the
    least raw score is half a point lower.
    """
    least = score - 0.5
    e = 1 - least / 100
    share = (1 - e) / (1 + e)
    dealt = _dealt(stored(_listed(stored(_token_keys(names, key)), share, e)), block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pairs leave as they are found: a group may have a great many.
        yield from fuzzy.pairs_of_block(pa.Table.from_batches(list(batches)), score, e, ratio)

    return dealt.groupBy("deal", "i", "j").applyInArrow(run, "a string, b string, score int")


def edit_pairs(names: DataFrame, distance: int, ratio: float = fixed.LENGTH_RATIO, key: str = "key") -> DataFrame:
    """J-08 with edit distance: (a, b, distance) for pairs of distinct keys, a < b, at most ``distance`` apart.

    An edit changes at most two of a key's padded pairs of characters, so of the rarest
    2 * distance + 1 of each side one is shared; keys with no more pairs than that, which need
    not share any, meet by length, and there are only so many keys of so few characters.
    """
    keys = names.select(F.col(key).alias("k")).where("k IS NOT NULL AND k <> ''").distinct().withColumn("n", F.length("k"))
    pairs = F.transform(F.sequence(F.lit(1), F.col("n") + 1), lambda i: F.substring(F.concat(F.lit("\u0001"), "k", F.lit("\u0001")), i, F.lit(2)))
    keys = keys.withColumn("pairs", F.array_sort(pairs))
    keys = stored(keys.withColumn("grams", F.transform("pairs", lambda g, i: F.concat(g, (i + 1 - F.array_position("pairs", g)).cast("string")))).drop("pairs"))
    each = keys.select("k", F.explode("grams").alias("element"))
    often = each.groupBy("element").agg(F.count(F.lit(1)).alias("often"))
    lists = each.join(often, "element").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("all")).join(keys.select("k", "n"), "k")
    rare = F.transform(F.slice("all", 1, 2 * distance + 1), lambda x: x["element"])
    short = F.col("n") + 1 <= 2 * distance
    # A short key also stands under each length that it may be changed to.
    lengths = F.transform(F.sequence(F.col("n") - distance, F.col("n") + distance), lambda i: F.concat(F.lit("\u0002"), i.cast("string")))
    own = F.array(F.concat(F.lit("\u0002"), F.col("n").cast("string")))
    rows = stored(lists.select("k", "n", F.explode(F.concat(rare, F.when(short, lengths).otherwise(F.when(F.col("n") + 1 <= 3 * distance, own).otherwise(F.array().cast("array<string>"))))).alias("element")))
    l, r = rows.alias("l"), rows.alias("r")
    met = l.join(r, F.expr(f"l.element = r.element AND l.k < r.k AND abs(l.n - r.n) <= {distance} AND least(l.n, r.n) >= {ratio} * greatest(l.n, r.n)"))
    found = met.select(F.col("l.k").alias("a"), F.col("r.k").alias("b")).distinct()
    return found.withColumn("distance", F.levenshtein("a", "b", distance)).where("distance >= 0")


def clusters(links: DataFrame, keep: str = "path") -> DataFrame:
    """ER-05: (node, root): the smallest key that a chain of links reaches; min-label rounds with path halving."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both)
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        near = both.join(grown(labels.withColumnRenamed("node", "b")), "b").groupBy("a").agg(F.min("root").alias("near"))
        hooked = labels.join(grown(near), labels["node"] == near["a"]).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        hop = hooked.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = stored(hooked.join(grown(hop), "root", "left").select("node", "old", F.least("root", F.coalesce("further", "root")).alias("root")))
        if after.where("root <> old").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")


def review(names: DataFrame, found: DataFrame, canonical: DataFrame, name: str = "name", key: str = "key") -> DataFrame:
    """ER-06, SL-01: clusters of at least two names, numbered by size and smallest name, with a membership flag.

    The numbers carry the order; a reader who wants sorted rows sorts what it shows.
    """
    member = names.join(found, names[key] == found["node"]).select(name, key, "root")
    meta = member.groupBy("root").agg(F.count(F.lit(1)).alias("cluster_size"), F.min(name).alias("first")).where("cluster_size >= 2")
    meta = surrogate_ids(meta, [F.desc("cluster_size"), F.asc("first")], "cluster_id")
    flag = canonical.select(F.col(canonical.columns[0]).alias(name)).distinct().withColumn("has_in_company_mapping", F.lit(1))
    out = member.join(meta, "root").join(flag, name, "left")
    return out.select("cluster_id", "cluster_size", name, F.coalesce("has_in_company_mapping", F.lit(0)).alias("has_in_company_mapping"), key)
