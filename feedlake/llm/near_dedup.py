r"""Near-duplicate detection: MinHash with tensored banding, verified on full shingle sets.

Words are runs of characters other than blank, tab and line breaks, A-Z in lower case; the set
of a text is that of its shingles of ``width`` words.  Texts of one set are one *node*, so
copies cost nothing further.

Banding with tables of ``2 k`` minhashes each would need ``2 k`` hash functions per table.
Instead two small collections of ``side`` sub-keys, ``k`` minhashes each, are made, and the key
of a table is a pair of one sub-key from each collection: ``side * side`` tables from
``2 * side * k`` minhashes, about the square root of the work.  Nodes that share a table key
are candidates.  Two sets of similarity s share a key unless one whole collection differs:
at s = 0.8 with the defaults that happens once in 100,000 pairs, at 0.85 once in 5 million.
A sub-key that only one node has makes no pair, so it is dropped before pairs are formed.

Links are confirmed by the exact similarity of the full sets, but not all pairs of a bucket
are made.  Every bucket names a centre, the member that shares most keys with others, and
its members are compared with it; links are joined to components, and a bucket whose members
are all in one component is done.  For the members of the other buckets the rest is exact: shingles are
ordered from rare to frequent, and two sets that are similar enough have their first common
shingle so early in both that enough shingles can follow, earlier in the smaller set than in the
larger.  Members of different components that meet on a shingle this early are compared.  Members
of one component never are, so a large group of near copies is not squared.  A text with more
shingles of its own than a link allows has only those in the places of the smaller set, so texts
of one template that are no near copies do not meet either; and no link that could join two
components is skipped.

Rows.  Texts without words have an empty set and are linked with nothing; a text of fewer than
``width`` words has one shingle.  Texts are read whole.  A component is named by its smallest
id; null ids come in only if there is no other.  A document is kept if it bears the name of its component,
so repeated rows with that id are kept together (exact deduplication parts them).  An empty
table gives an empty result.  Other columns are carried along by ``drop_near_copies``.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import beside, blank_words, fresh, remove, ship, store
from feedlake.llm.components import components

WIDTH = 5
SIDE, K = 12, 2
SKETCH = "n_shingles long, d1 long, d2 long, heads array<long>, tails array<long>"


def shingles(text: str | None, width: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted."""
    words = blank_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    take = min(width, len(words))
    rolled = np.zeros(len(words) - take + 1, np.uint64)
    for j in range(take):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(rolled)]
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(len(words) if len(words) < width else width))


@cache
def _factors(n: int) -> np.ndarray:
    """Odd numbers: multiplying by one permutes the hashes."""
    return np.random.default_rng(20_240_501).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(found: np.ndarray, n: int) -> np.ndarray:
    return (_factors(n)[:, None] * found[None, :]).min(axis=1)


def _signed(words: bytes) -> tuple[int, ...]:
    return tuple(int(x) for x in np.frombuffer(words, np.int64))


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, side: int = SIDE, k: int = K) -> DataFrame:
    """``doc_id``, a hash of the text, size and 128-bit digest of its set, and its two collections of sub-keys."""
    ship(docs.sparkSession)

    def sketch(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            found = shingles(text, width)
            d1, d2 = _signed(xxhash.xxh3_128_digest(found.tobytes()))
            keys = ()
            if len(found):
                bands = minhashes(found, 2 * side * k).reshape(2 * side, k)
                keys = tuple(xxhash.xxh3_64_intdigest(b.tobytes(), i) - (1 << 63) for i, b in enumerate(bands))
            out.append((len(found), d1, d2, list(keys[:side]), list(keys[side:])))
        return pd.DataFrame(out, columns=["n_shingles", "d1", "d2", "heads", "tails"])

    udf = F.pandas_udf(sketch, SKETCH).asNondeterministic()  # evaluated once
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), udf(text).alias("sketch"))
    return rows.select("doc_id", "text_key", "sketch.*")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, repeated: bool) -> DataFrame:
    """``node`` and its full set, one row for each of the given (stored) nodes; ``repeated``: rows may occur more than once."""

    def full(texts: pd.Series) -> pd.DataFrame:
        found = [shingles(t, width) for t in texts]
        digests = [_signed(xxhash.xxh3_128_digest(f.tobytes())) for f in found]
        return pd.DataFrame(
            {"s1": [d[0] for d in digests], "s2": [d[1] for d in digests], "found": [f.view(np.int64) for f in found]}
        )

    udf = F.pandas_udf(full, "s1 long, s2 long, found array<long>").asNondeterministic()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.join(beside(nodes), F.col("id").eqNullSafe(F.col("first_id")) & (F.xxhash64("text") == F.col("first_key")))
    own = texts.withColumn("set", udf("text")).filter("set.s1 = d1 AND set.s2 = d2").select("node", "n", "set.found")
    return own.dropDuplicates(["node"]) if repeated else own


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose sets are similar enough."""
    a, b = sets.select(F.col("node").alias("a"), F.col("found").alias("set_a")), sets.select(F.col("node").alias("b"), F.col("found").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .select("a", "b", both.alias("both"), F.size("set_a").alias("na"), F.size("set_b").alias("nb"))
        .filter(f"100L * both >= {percent}L * (na + nb - both)")
        .select("a", "b")
        .distinct()
    )


def _fit(percent: int) -> F.Column:
    """Sizes that allow the similarity at all."""
    return F.expr(f"100L * least(n, other_n) >= {percent}L * greatest(n, other_n)")


def table_buckets(nodes: DataFrame) -> DataFrame:
    """``key``, ``node``, ``n`` for all table keys that several nodes share."""
    subs = nodes.select("node", "n", F.size("heads").alias("side"), F.posexplode(F.concat("heads", "tails")).alias("slot", "sub"))
    several = lambda rows, key: rows.groupBy(key).agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select(key)
    shared = (
        subs.join(several(subs, "sub").hint("rebalance"), "sub", "left_semi")
        .groupBy("node", "n")
        .agg(
            F.collect_list(F.when(F.col("slot") < F.col("side"), F.col("sub"))).alias("heads"),
            F.collect_list(F.when(F.col("slot") >= F.col("side"), F.col("sub"))).alias("tails"),
        )
    )
    pair = F.expr("explode(flatten(transform(heads, h -> transform(tails, t -> xxhash64(h, t)))))")
    keys = shared.select("node", "n", pair.alias("key"))
    return keys.join(several(keys, "key").hint("rebalance"), "key", "left_semi")


def _placed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their component."""
    placed = buckets.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sides = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return placed.join(sides.select("key").hint("rebalance"), "key", "left_semi")


def _centres(buckets: DataFrame) -> DataFrame:
    """(key, centre, its size): the member that shares most keys with others."""
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    popular = buckets.join(sizes.hint("rebalance"), "key").groupBy("node").agg(F.sum("size").alias("popularity"))
    best = buckets.join(popular, "node").groupBy("key").agg(F.max(F.struct("popularity", "node", "n")).alias("c"))
    return best.select("key", F.col("c.node").alias("b"), F.col("c.n").alias("other_n"))


def _early(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The shingles of each member that come early enough, from rare to frequent, to be the first one in common.

    ``members``: ``node``, ``component``.  Of two similar sets the larger one has its first common shingle within the
    first ``n - ceil(p n) + 1`` places, the smaller one (``indexed``) within ``n - ceil(2 p / (1 + p) n) + 1``.  ``main`` is the component
    that holds most texts of a shingle; shingles of one component are left out.  The first table is a stored one, without ``main``.
    """
    shingles_ = members.join(sets, "node").select("node", "component", "n", F.explode("found").alias("shingle"))
    often = shingles_.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("node").orderBy("often", "shingle")
    # Sizes of similar sets are in the same class or in neighbouring ones.
    size_class = F.floor(F.log("n") / F.log(F.lit(100.0 / percent)) + 1e-9) if percent < 100 else F.col("n")
    early = (
        shingles_.join(often, "shingle")
        .withColumn("place", F.row_number().over(order))
        .filter(f"often > 1 AND 100L * (n - place + 1) >= {percent}L * n")
        .withColumn("indexed", F.expr(f"{100 + percent}L * (n - place + 1) >= {2 * percent}L * n"))
        .withColumn("size_class", size_class)
    )
    ranked = store(early.select("shingle", "node", "component", "n", "place", "indexed", "size_class"), "ranked")
    counts = ranked.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("texts"))
    main = (
        counts.groupBy("shingle")
        .agg(F.max(F.struct("texts", "component")).alias("m"), F.count(F.lit(1)).alias("components"))
        .filter("components > 1")
        .select("shingle", F.col("m.component").alias("main"))
    )
    return ranked, ranked.join(main.hint("rebalance"), "shingle")


def _meetings(early: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components that meet on an early shingle and can be similar, once per such shingle.

    An overlap of o is enough if (100 + p) o >= p (na + nb); from a common shingle at places i and j at most
    1 + min(na - i, nb - j) can follow.  Texts of one template, whose own shingles are too many for a link, come
    before the shared ones, so the shared ones are not indexed: such texts do not meet.
    """
    small = early.filter("indexed").select(
        "shingle", "size_class", "main", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("place").alias("i")
    )
    classes = F.array("size_class", F.col("size_class") - 1)
    large = early.select(
        "shingle", F.explode(classes).alias("size_class"), "main", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("place").alias("j")
    )
    # Two texts of the main component never meet, so a large group of near copies is not squared.
    sides = ((small.filter("ca <> main"), large), (small.filter("ca = main"), large.filter("cb <> main")))
    fits = F.expr(
        f"ca <> cb AND (na < nb OR na = nb AND a < b) AND 100L * na >= {percent}L * nb"
        f" AND {100 + percent}L * (1 + least(na - i, nb - j)) >= {percent}L * (na + nb)"
    )
    met = [
        x.drop("main").hint("rebalance", "shingle", "size_class").join(y.drop("main").hint("rebalance", "shingle", "size_class"), ["shingle", "size_class"])
        for x, y in sides
    ]
    return met[0].unionByName(met[1]).filter(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def find_links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, percent: int, repeated: bool) -> DataFrame:
    """``node`` and ``component`` of all nodes that are linked with another one."""
    buckets = store(table_buckets(nodes), "buckets")
    members = buckets.select("node").distinct()
    wanted = nodes.join(members, "node", "left_semi").select("node", "first_id", "first_key", "d1", "d2", "n")
    wanted = store(wanted, "wanted")
    sets = store(_sets(docs, wanted, id_col, text_col, width, repeated), "sets")
    remove(wanted)
    with_centre = (
        buckets.join(_centres(buckets).hint("rebalance"), "key")
        .filter((F.col("node") != F.col("b")) & _fit(percent))
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
        .distinct()
    )
    links = store(_confirmed(with_centre, sets, percent), "links")
    labels = store(components(links), "labels")
    remove(links)
    rest = store(_placed(buckets, labels).select("node", "component").distinct(), "rest")
    remove(buckets)
    ranked, early = _early(rest, sets, percent)
    early = store(early, "early")
    remove(ranked)
    found = store(_confirmed(_meetings(early, percent).distinct(), sets, percent), "links")
    for used in (sets, rest, early):
        remove(used)
    if found.isEmpty():
        return labels
    # The labels are stars already: the search goes on from them, not from all links.
    out = components(found.union(labels.filter("node <> component")))
    remove(found)
    remove(labels)
    return out


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and a hash of its text."""
    rows = store(sketches(docs, id_col, text_col, width), "sketches")
    filled = rows.filter("n_shingles > 0")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_key"))  # null ids last
    grouped = (
        filled.groupBy("d1", "d2", F.col("n_shingles").alias("n"), "heads", "tails")
        .agg(first.alias("first"))
        .select("d1", "d2", "n", "heads", "tails", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = store(grouped, "nodes")  # written, so that the numbers stay
    repeated = not filled.groupBy("doc_id", "text_key").count().filter("count > 1").isEmpty()
    linked = find_links(docs, nodes, id_col, text_col, width, percent, repeated)
    placed = nodes.select("node", "d1", "d2", "first_id").join(linked, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = placed.join(names.hint("rebalance"), "component").select("d1", "d2", "component_id")
    out = rows.join(named.hint("rebalance"), ["d1", "d2"], "left")
    empty = F.col("n_shingles") == 0
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = 80) -> DataFrame:
    """The rows of the documents that stay, with all their columns."""
    gone, key = fresh(docs, "gone_id"), fresh(docs, "gone_key")
    dropped = decide(docs, id_col, text_col, width, percent).filter("NOT kept").select("doc_id", "text_key").distinct()
    this = F.col(id_col).eqNullSafe(F.col(gone)) & (F.xxhash64(F.col(text_col)) == F.col(key))
    return docs.join(beside(store(dropped.toDF(gone, key), "dropped")), this, "left_anti")
