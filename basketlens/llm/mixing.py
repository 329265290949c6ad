"""Mixing sources to target weights, by budgets handed down a tree.

The tree's levels are columns, by default domain, language and source. A budget of
tokens enters at the root. At each node it is shared among the children in
proportion to their weights, but no child gets more than all leaves below it can
supply; what a child cannot take goes to its siblings, again by weight. As a
child's supply counts everything below it, a shortage is made up for by the
nearest siblings first and reaches an ancestor's level only when the whole
subtree is used up.

A leaf supplies its documents ``epochs`` times. In each epoch they have another
order, a hash of seed, epoch and id; whole epochs are taken, and of the last one
the longest prefix whose tokens fit in what is left.

The prefix sums need no task that holds a leaf: the range of the hash is cut into
cells, their totals are summed, and only in the cell where the budget ends are
single documents ordered.

Defined cases: null level values form children of their own; documents without
tokens have no cost and come with the prefix they lie in (all, if everything is
taken); a null id is ordered by its text's length; documents with equal hashes (in
particular repeated rows) are ordered by their number of tokens and taken
together or not at all; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.llm.tables import WORD, word_count
from basketlens.sources.landing import land

LEVELS = ("domain", "lang", "source")
#: The budget as a share of all tokens, and how often a document may be taken.
BUDGET_SHARE = (4, 5)
EPOCHS = 2
SEED = 17
#: Documents that a cell of the hash's range should hold.
CELL_ROWS = 1024
MAX_CELLS = 65_536
#: Leaves that are broadcast at most.
BROADCAST_LEAVES = 20_000

#: Target weights of the children of any node: by level and value, 1 where none is given.
WEIGHTS = {"lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def domain_of(source: Column) -> Column:
    """A stand-in, as the tables have no domains: sources in four groups by their number."""
    number = F.regexp_extract(source, r"([0-9]{1,18})\z", 1)
    return F.when(number == "", "other").otherwise(
        F.concat(F.lit("domain"), (F.nullif(number, F.lit("")).cast("long") % 4).cast("string"))
    )


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("decimal(18,0)")


def _big(column: Column) -> Column:
    return column.cast("decimal(18,0)")


def share_out(nodes: DataFrame, parents: Sequence[str], level: str) -> DataFrame:
    """``grant`` of each child, from its parent's ``budget``, its ``weight`` and its ``supply``.

    In the order of supply per weight, a child is filled up as long as its share of
    what is left would exceed its supply; all later ones get that share, rounded
    down. Children of weight 0 get nothing. There is a row for each value of a
    level, not for documents.
    """
    order = W.partitionBy(*parents).orderBy("ratio", level)
    siblings = W.partitionBy(*parents)

    def before(column: str) -> Column:
        earlier = order.rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    ratio = F.when(F.col("weight") > 0, F.col("supply").cast("double") / F.col("weight").cast("double"))
    placed = nodes.withColumn("ratio", F.coalesce(ratio, F.lit(float("inf")))).select(
        "*",
        _big(F.greatest(F.col("budget") - before("supply"), F.lit(0))).alias("left"),
        _big(F.sum("weight").over(siblings) - before("weight")).alias("open_weight"),
    )
    full = _big(F.col("supply")) * F.col("open_weight") <= F.col("left") * F.col("weight")
    marked = placed.withColumn("full", full & (F.col("weight") > 0))
    # All children after the filled ones share what the first of them finds left.
    shared = marked.select(
        "*",
        F.max(F.when(~F.col("full"), F.col("left"))).over(siblings).alias("a"),
        F.max(F.when(~F.col("full"), F.col("open_weight"))).over(siblings).alias("b"),
    )
    part = F.when(F.col("b") > 0, F.expr("a * weight div b")).otherwise(0)
    grant = F.when(F.col("full"), F.col("supply")).otherwise(part).cast("long")
    return shared.withColumn("grant", grant)


def budgets(docs: DataFrame, levels: Sequence[str] = LEVELS, tokens: str = "n_tokens",
            epochs: int = EPOCHS, share: tuple[int, int] = BUDGET_SHARE,
            weights: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """A row for each leaf: the levels, tokens, docs and budget.

    ``share`` is the root's budget as a fraction of all tokens.
    """
    weights = WEIGHTS if weights is None else weights
    leaves = docs.groupBy(*levels).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("docs"))
    leaves = land(leaves, "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    nodes = leaves.withColumn("budget", F.lit(total * share[0] // share[1]).cast("long"))
    for i, level in enumerate(levels):
        path = list(levels[: i + 1])
        children = nodes.groupBy(*path).agg(
            (F.sum("tokens") * epochs).alias("supply"), F.max("budget").alias("budget")
        ).withColumn("weight", _weight(level, weights))
        granted = share_out(children, path[:-1], level).select(
            *[F.col(c).alias(f"__{c}") for c in path], "grant"
        )
        nodes = (
            nodes.join(granted, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in path])
            .select(*levels, "tokens", "docs", F.col("grant").alias("budget"))
        )
    return nodes


def _with_leaf(docs: DataFrame, leaves: DataFrame, levels: Sequence[str]) -> DataFrame:
    """``docs`` with the columns of their leaf; ``leaves`` is a landed table.

    Leaves are broadcast if there are ``BROADCAST_LEAVES`` at most, else joined by a
    shuffle, in which adaptive execution splits hot leaves.
    """
    small = leaves.count() <= BROADCAST_LEAVES
    named = leaves.select(*[F.col(c).alias(f"__{c}") if c in levels else F.col(c) for c in leaves.columns])
    meet = [docs[c].eqNullSafe(named[f"__{c}"]) for c in levels]
    return docs.join(F.broadcast(named) if small else named, meet).drop(*[f"__{c}" for c in levels])


def mix(docs: DataFrame, levels: Sequence[str] = LEVELS, tokens: str = "n_tokens", key: str = "doc_id",
        epochs: int = EPOCHS, share: tuple[int, int] = BUDGET_SHARE, seed: int = SEED,
        weights: dict[str, dict[str, int]] | None = None, epoch_name: str = "epoch") -> DataFrame:
    """The chosen rows of ``docs`` and their epoch, from 1; a row for each epoch.

    A column which is already called ``epoch_name`` gives way.

    Budgets and prefixes are found on the narrow columns alone. Of the rows of
    ``docs`` only those in cells where a budget ends are shuffled.
    """
    names = [n for n in docs.columns if n != epoch_name]
    narrow = land(docs.select(*levels, key, tokens), "mixing")
    # Whole epochs, what is left for one more, and how many cells the leaf's documents need.
    some = F.col("tokens") > 0
    plan = budgets(narrow, levels, tokens, epochs, share, weights).select(
        *levels,
        F.when(some, F.least(F.expr("budget div tokens"), F.lit(epochs))).otherwise(epochs).alias("__whole"),
        F.when(some, F.expr("budget % tokens")).otherwise(0).alias("__rest"),
        F.least(F.greatest(F.ceil(F.col("docs") / CELL_ROWS), F.lit(1)), F.lit(MAX_CELLS)).alias("__cells"),
    )
    plan = land(plan, "mixing-plan")
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null-"), F.col(tokens).cast("string")))

    def dealt(rows: DataFrame, epoch: Column) -> DataFrame:
        """Rows with their place in an epoch's order."""
        ordered = rows.withColumn("__epoch", epoch.cast("int")).withColumn(
            "__order", F.md5(F.concat_ws(":", F.lit(seed), "__epoch", name))
        )
        first = F.conv(F.substr("__order", F.lit(1), F.lit(8)), 16, 10).cast("double")
        return ordered.withColumn("__cell", F.floor(first / 2.0**32 * F.col("__cells")))

    def partial(rows: DataFrame) -> DataFrame:
        return dealt(rows.where((F.col("__whole") < epochs) & (F.col("__rest") > 0)), F.col("__whole") + 1)

    # The cell where each leaf's budget ends, from one row for each cell.
    totals = partial(_with_leaf(narrow, plan, levels)).groupBy(*levels, "__cell").agg(
        F.sum(tokens).alias("t"), F.max("__rest").alias("rest")
    )
    running = F.sum("t").over(W.partitionBy(*levels).orderBy("__cell"))
    ends = totals.select(*levels, "__cell", (F.col("rest") - running + F.col("t")).alias("room"), "t").where(
        (F.col("room") >= 0) & (F.col("t") > F.col("room"))
    ).select(*levels, F.col("__cell").alias("__end"), F.col("room").alias("__room"))
    ends = land(ends, "mixing-ends")
    columns = [*[F.col(f"`{n}`") for n in names], F.col("__epoch").alias(epoch_name)]
    whole = (
        _with_leaf(docs, plan, levels).where("__whole > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("__whole").cast("int"))))
    )
    placed = _with_leaf(partial(_with_leaf(docs, plan, levels)), ends, levels)
    within = W.partitionBy(*levels, "__cell").orderBy("__order", tokens)
    ended = placed.where("__cell = __end").withColumn("__sum", F.sum(tokens).over(within))
    return (
        whole.select(*columns)
        .unionByName(placed.where("__cell < __end").select(*columns))
        .unionByName(ended.where("__sum <= __room").select(*columns))
    )


def mixing_query(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        "doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", word_count("text").alias("n_tokens")
    )
    return mix(land(rows, "counted"))


def _level_sql(i: int) -> str:
    """One level of the tree: the grants of its children, from the leaves before it."""
    path = ", ".join(LEVELS[: i + 1])
    parents = f"PARTITION BY {', '.join(LEVELS[:i])}" if i else ""
    level = LEVELS[i]
    cases = " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in WEIGHTS.get(level, {}).items())
    weight = f"CASE {cases} ELSE 1 END" if cases else "1"
    meet = " AND ".join(f"l.{c} IS NOT DISTINCT FROM g.{c}" for c in LEVELS[: i + 1])
    order = f"{parents} ORDER BY ratio, {level} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""
c{i} AS (SELECT {path}, (sum(tokens) * {EPOCHS})::HUGEINT AS supply, max(budget)::HUGEINT AS budget,
  ({weight})::HUGEINT AS weight FROM n{i} GROUP BY ALL),
r{i} AS (SELECT *, supply::DOUBLE / weight::DOUBLE AS ratio FROM c{i}),
p{i} AS (SELECT *, greatest(budget - coalesce(sum(supply) OVER ({order}), 0), 0)::HUGEINT AS room,
  (sum(weight) OVER ({parents}) - coalesce(sum(weight) OVER ({order}), 0))::HUGEINT AS open_weight FROM r{i}),
f{i} AS (SELECT *, supply * open_weight <= room * weight AS filled FROM p{i}),
g{i} AS (SELECT *, CASE WHEN filled THEN supply ELSE
  (max(room) FILTER (NOT filled) OVER ({parents})) * weight
  // (max(open_weight) FILTER (NOT filled) OVER ({parents})) END AS granted FROM f{i}),
n{i + 1} AS (SELECT l.* EXCLUDE (budget), g.granted AS budget FROM n{i} l JOIN g{i} g ON {meet})"""


def mixing_sql() -> str:
    meet = " AND ".join(f"d.{c} IS NOT DISTINCT FROM l.{c}" for c in LEVELS)
    leaf = ", ".join(LEVELS)
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]{{1,18}})\\z', 1) = '' THEN 'other'
    WHEN source IS NOT NULL THEN 'domain' || (regexp_extract(source, '([0-9]{{1,18}})\\z', 1)::HUGEINT % 4) END AS domain,
  lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_tokens FROM documents),
n0 AS MATERIALIZED (SELECT {leaf}, sum(n_tokens)::HUGEINT AS tokens,
  (SELECT sum(n_tokens)::HUGEINT * {BUDGET_SHARE[0]} // {BUDGET_SHARE[1]} FROM d) AS budget FROM d GROUP BY ALL),
{",".join(_level_sql(i) for i in range(len(LEVELS)))},
plan AS (SELECT *, CASE WHEN tokens > 0 THEN least(budget // tokens, {EPOCHS}) ELSE {EPOCHS} END AS whole,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM n{len(LEVELS)}),
e AS (SELECT d.*, x.epoch::INTEGER AS epoch, whole, rest,
  md5(concat_ws(':', {SEED}, x.epoch, coalesce(doc_id::VARCHAR, 'null-' || n_tokens))) AS place
  FROM d JOIN plan l ON {meet} CROSS JOIN (SELECT unnest(range(1, {EPOCHS + 1})) AS epoch) x),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {leaf}, epoch ORDER BY place, n_tokens) AS running FROM e)
SELECT doc_id, {leaf}, n_tokens, epoch FROM s
WHERE epoch <= whole OR (epoch = whole + 1 AND rest > 0 AND running <= rest)"""
