r"""Mixing sources to target weights by hierarchical budgets.

Documents hang on a tree: domain, language, source.  A budget of tokens (blank-separated
words) goes down the tree by integer weights.  No node can take more than its documents hold in
``max_epochs`` epochs; what a node cannot take goes to its siblings by their weights, and only
what all siblings together cannot take was never given to their parent: a level is filled
knowing what the subtrees below can hold.  Each level is filled exactly, by sorting
siblings by capacity per weight and finding the level of the water from running sums.

A leaf reads its documents in the order of a seeded hash, anew in each epoch, and takes the
first tokens up to its budget: whole epochs, then whole documents, then the first tokens of one
last document.  That place is found from sums over slices of the hash, and only the one
slice that holds it is sorted, so a leaf with a third of all rows is never in one task.

Rows.  A null language, source or domain is the node ``(none)``.  Documents without tokens are
never taken.  Repeated rows with one id and text are one unit of the order; if the budget ends in
it, its rows share the rest evenly, rounded down.  Nodes of weight 0 get nothing.  Shares are
rounded down, so at most one token per node is left over.  An empty table gives an empty result.
All columns are kept; the mix is one new struct column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import fresh, store

TREE = ("domain", "lang", "source")
NONE = "(none)"
TOKEN = r"[^\x20\x09-\x0D]+"
#: Documents of a leaf in one slice of the hash, about.
_SLICE = 10_000


@dataclass(frozen=True)
class Plan:
    """Where a document hangs, what weighs what, and how much to take.

    ``domain`` is an SQL expression over the documents; weights that are not named are ``other``.
    """

    domain: str
    domain_weights: dict[str, int]
    lang_weights: dict[str, int]
    source_weights: dict[str, int]
    other: tuple[int, int, int] = (1, 1, 1)
    share_percent: int = 60
    budget: int | None = None  # tokens; in place of the share
    max_epochs: int = 3
    seed: int = 17

    def weights(self) -> tuple[tuple[dict[str, int], int], ...]:
        return tuple(zip((self.domain_weights, self.lang_weights, self.source_weights), self.other, strict=True))


def n_tokens(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0)).cast("long")


def _weight(level: int, plan: Plan) -> Column:
    known, other = plan.weights()[level]
    out = F.lit(other)
    for name, weight in sorted(known.items()):
        out = F.when(F.col(TREE[level]) == name, weight).otherwise(out)
    return out.cast("long")


def fill(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``given`` for nodes with ``cap``, ``weight`` and the ``budget`` of their parent."""
    big = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")
    group = Window.partitionBy(*(parent or [F.lit(0)]))
    order = group.orderBy(F.col("cap") / F.col("weight"), nodes.columns[len(parent)])
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    weighed = nodes.filter("weight > 0")
    full = big("cap") * F.sum("weight").over(after) <= (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) * big("weight")
    marked = weighed.withColumn("full", full)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))
    return (
        marked.withColumn("left_over", left)
        .withColumn("open_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(group))
        .withColumn("share", F.expr("cast(cast(left_over as decimal(38,0)) * weight div open_weight as long)"))
        .withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(F.col("share")))
        .drop("full", "left_over", "open_weight", "share")
    )


def budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """``given`` tokens of every leaf; ``leaves`` has the tree's columns and ``tokens``."""
    capped = leaves.withColumn("cap", F.col("tokens") * plan.max_epochs)
    if plan.budget is None:
        total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {plan.share_percent} div 100").alias("budget"))
    else:
        total = leaves.agg(F.lit(plan.budget).cast("long").alias("budget"))
    above = total
    for level in range(3):
        names = list(TREE[: level + 1])
        nodes = capped.groupBy(*names).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, plan))
        # One row holds the total; below, a node meets the row of its parent.
        nodes = nodes.join(above, names[:-1]) if level else nodes.join(above.withColumn("one", F.lit(1)), F.lit(1) == F.col("one")).drop("one")
        given = fill(nodes.select(*names, "cap", "weight", "budget"), names[:-1])
        above = given.select(*names, F.col("given").alias("budget"))
    return above.withColumnRenamed("budget", "given")


def _rank(plan: Plan, epoch: Column, doc_id: Column, digest: Column) -> Column:
    parts = F.lit(str(plan.seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), digest
    return F.md5(F.concat_ws(":", *parts))


def cuts(rows: DataFrame, plan: Plan) -> DataFrame:
    """Per leaf: ``epochs`` to take whole, and of the next the rank ``last``, of which ``part`` tokens are taken.

    ``rows``: the tree's columns, ``id``, ``digest`` of the text and ``tokens``.
    """
    leaf = list(TREE)
    leaves = store(rows.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "leaves")
    given = store(
        leaves.join(budgets(leaves, plan), leaf)
        .withColumn("epochs", F.expr("given div tokens"))
        .withColumn("rest", F.expr("given % tokens"))
        .withColumn("digits", F.greatest(F.lit(1), F.ceil(F.log(16.0, F.col("rows") / _SLICE))).cast("int")),
        "budgets",
    )
    ranked = (
        rows.join(given.select(*leaf, "epochs", "rest", "digits"), leaf)
        .filter("rest > 0")
        .withColumn("rank", _rank(plan, F.col("epochs"), F.col("id"), F.col("digest")))
        .withColumn("slice", F.expr("left(rank, digits)"))
    )
    slices = ranked.groupBy(*leaf, "slice").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    along = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    here = (
        slices.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
        .filter("before < rest AND rest <= before + n")
        .select(*leaf, "slice", "before")
    )
    units = ranked.join(here, [*leaf, "slice"]).groupBy(*leaf, "rank").agg(
        F.sum("tokens").alias("n"), F.count(F.lit(1)).alias("copies"), F.max("before").alias("start"), F.max("rest").alias("rest")
    )
    within = Window.partitionBy(*leaf).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        units.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0)))
        .filter("before < rest AND rest <= before + n")
        .select(*leaf, F.col("rank").alias("last"), F.expr("(rest - before) div copies").alias("part"))
    )
    return given.select(*leaf, "epochs").join(last, leaf, "left")


def mix(docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", into: str = "mix") -> DataFrame:
    """The documents taken, once per epoch, with a struct ``into``, which must be a new name (see ``common.fresh``).

    It holds the leaf (domain, lang, source), ``epoch``, ``n_tokens`` and ``take_tokens``; the
    text is cut to the tokens taken.
    """
    if fresh(docs, into) != into:
        raise ValueError(f"the documents have a column {into}")
    taken = fresh(docs.withColumn(into, F.lit(0)), "taken")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = lambda c: F.col(f"`{into}`.{c}")
    node = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    place = F.struct(
        node(F.expr(plan.domain)).alias("domain"),
        node(F.col(lang_col)).alias("lang"),
        node(F.col(source_col)).alias("source"),
        F.col(id_col).alias("id"),
        F.md5(text).alias("digest"),
        n_tokens(text).alias("tokens"),
    )
    placed = docs.withColumn(into, place).filter(own("tokens") > 0)
    rows = store(placed.select(f"`{into}`.*"), "tokens")
    # One row per leaf; written, so that Spark knows its size and need not move texts to meet it.
    cut = store(cuts(rows, plan), "cuts")
    met = placed.join(cut, (own("domain") == cut["domain"]) & (own("lang") == cut["lang"]) & (own("source") == cut["source"]))
    rank = _rank(plan, cut["epochs"], own("id"), own("digest"))
    part = F.when(rank < cut["last"], own("tokens")).when(rank == cut["last"], cut["part"]).otherwise(F.lit(0))
    nothing = F.array().cast("array<struct<epoch:bigint,take:bigint>>")
    whole = F.transform(F.sequence(F.lit(0).cast("long"), cut["epochs"] - 1), lambda e: F.struct(e.alias("epoch"), own("tokens").alias("take")))
    last = F.array(F.struct(cut["epochs"].alias("epoch"), part.alias("take")))
    out = met.withColumn(
        taken, F.explode(F.concat(F.when(cut["epochs"] > 0, whole).otherwise(nothing), F.when(part > 0, last).otherwise(nothing)))
    )
    take = F.col(f"`{taken}`.take")
    facts = F.struct(
        *[own(c).alias(c) for c in TREE],
        F.col(f"`{taken}`.epoch").alias("epoch"),
        own("tokens").alias("n_tokens"),
        take.alias("take_tokens"),
    )
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + TOKEN), 0)
    cut_text = F.when(take < own("tokens"), F.array_join(F.slice(pieces, F.lit(1), take.cast("int")), "")).otherwise(F.col(text_col))
    return out.select(*[(cut_text if c == text_col else docs[c]).alias(c) for c in docs.columns], facts.alias(into))
