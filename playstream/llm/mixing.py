"""Mixing sources to target weights down a tree of domains, languages and sources, in DataFrame functions only.

A token budget is handed down the tree in proportion to weights. A node that cannot use its part (its documents, repeated
``max_epochs`` times, are too few) leaves the rest to its siblings; only what they cannot use either stays with
the node above and so reaches that node's own siblings. Each leaf then takes whole epochs of its documents and
the prefix of one more, in an order seeded for that epoch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playstream.llm.common import settled

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
#: Weights of tree nodes by path; 1 where none is given. Domains are weighed against domains, the languages of a
#: domain against each other, and so on.
WEIGHTS = {"d0": 3, "d1": 2, "d0/en": 4, "d1/en": 4, "d2/en": 4, "d3/en": 4, "d0/en/src0": 2}
BUDGET_PERCENT = 60
MAX_EPOCHS = 2
SEED = "mix-1"
#: Bits by which one pass narrows down where a leaf's prefix ends, and the number of passes.
STEP_BITS, PASSES, HASH_BITS = 6, 3, 60


def domain_of(source: Column) -> Column:
    """``d0`` to ``d3`` by the number that a source's name ends with; ``other`` without one."""
    number = F.regexp_extract(source, "([0-9])$", 1)
    last_two = F.regexp_extract(source, "([0-9]{1,2})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (last_two.cast("int") % 4).cast("string"))).otherwise("other")


def tokens_of(text: Column) -> Column:
    """Estimated tokens: a quarter of the bytes, rounded up; none for a null."""
    return F.floor((F.coalesce(F.octet_length(text), F.lit(0)) + 3) / 4).cast("long")


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with their leaf in columns of its own and their tokens."""
    source = F.coalesce("source", F.lit(NONE))
    return docs.select(
        "*",
        F.struct(
            domain_of(source).alias("domain"), F.coalesce("lang", F.lit(NONE)).alias("lang"), source.alias("source")
        ).alias("_leaf"),
        tokens_of(F.col("text")).alias("_tokens"),
    )


def _weight(path: Column, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.element_at(table, path), F.lit(1))


def handed_down(nodes: DataFrame, parents: DataFrame, on: list[str], path: Column, weights: Mapping[str, int]) -> DataFrame:
    """``nodes`` (with ``capacity``) with their ``budget``, out of their parents' one.

    Siblings are ordered by capacity over weight. As long as the part that falls to the next one, of what is left,
    covers its capacity, it is filled; the others share the rest by weight, in whole tokens.
    """
    wide = "decimal(38,0)"
    weighed = nodes.join(parents.select(*on, F.col("budget").alias("above")), on)
    weighed = weighed.withColumn("w", _weight(path, weights).cast(wide)).withColumn("c", F.col("capacity").cast(wide))
    siblings = Window.partitionBy(*on)
    ratio = F.col("c").cast("double") / F.nullif(F.col("w"), F.lit(0)).cast("double")
    order = siblings.orderBy(ratio.asc_nulls_last(), path)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = weighed.select(
        "*",
        F.coalesce(F.sum("c").over(before), F.lit(0)).cast(wide).alias("filled"),
        F.sum("w").over(onward).cast(wide).alias("open"),
    )
    full = (F.col("w") > 0) & (F.col("c") * F.col("open") <= (F.col("above") - F.col("filled")) * F.col("w"))
    marked = ranked.withColumn("full", full)
    rest = F.col("above") - F.coalesce(F.sum(F.when(F.col("full"), F.col("c"))).over(siblings), F.lit(0))
    sharing = F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings), F.lit(0))
    shared = marked.withColumn("rest", rest.cast(wide)).withColumn("sharing", sharing.cast(wide))
    part = F.floor(F.col("w") * F.col("rest") / F.nullif(F.col("sharing"), F.lit(0).cast(wide)))
    budget = F.when(F.col("full"), F.col("c")).otherwise(F.least(F.coalesce(part, F.lit(0)), F.col("c")))
    return shared.withColumn("budget", budget.cast("long")).select(*nodes.columns, "budget")


def budgets(leaves: DataFrame, weights: Mapping[str, int], percent: int, max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with the tokens each is to give: ``budget``, whole ``epochs``, ``rest``."""
    sized = leaves.withColumn("root", F.lit(0)).withColumn("capacity", F.col("tokens") * max_epochs)
    above = sized.groupBy("root").agg(
        F.floor(F.coalesce(F.sum("tokens"), F.lit(0)).cast("decimal(38,0)") * percent / 100).cast("long").alias("budget")
    )
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        nodes = sized if depth == len(LEVELS) else sized.groupBy("root", *keys).agg(F.sum("capacity").alias("capacity"))
        above = handed_down(nodes, above, ["root", *keys[:-1]], F.concat_ws("/", *keys), weights)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    return above.drop("root").withColumn("epochs", whole).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def place_in_epoch(doc_id: Column, epoch: Column, seed: str) -> Column:
    """Where a document comes in an epoch: 60 bits of a digest."""
    name = F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def _cutoffs(keys: DataFrame, plan: DataFrame) -> DataFrame:
    """Per leaf the last ``(place, id, tokens)`` that its rest has room for.

    The place is narrowed down by sums over 64 ranges at a time, so no leaf is ever sorted as a whole; only the few
    documents of the last range are.
    """
    leaf = list(LEVELS)
    state = plan.where("rest > 0").select(*leaf, "rest", F.lit(0).cast("long").alias("prefix"))
    for k in range(PASSES):
        low = HASH_BITS - STEP_BITS * (k + 1)
        part = F.shiftright("place", low)
        inside = keys.join(state, leaf).where(F.shiftright(part, STEP_BITS) == F.col("prefix"))
        sums = inside.groupBy(*leaf, "rest", part.alias("part")).agg(F.sum("tokens").alias("tokens"))
        running = F.sum("tokens").over(Window.partitionBy(*leaf).orderBy("part"))
        state = settled(
            sums.withColumn("upto", running)
            .where("upto > rest")
            .groupBy(*leaf)
            .agg(F.min(F.struct("part", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest"))).alias("first"))
            .select(*leaf, F.col("first.rest").alias("rest"), F.col("first.part").alias("prefix")),
            "mix-ranges",
        )
    low = HASH_BITS - STEP_BITS * PASSES
    # Rows equal in place, id and tokens are taken alike, so a place that very many rows share is summed before it is sorted.
    last = (
        keys.join(state, leaf)
        .where(F.shiftright("place", low) == F.col("prefix"))
        .groupBy(*leaf, "rest", "place", "id", "tokens")
        .agg(F.sum("tokens").alias("together"))
    )
    running = F.sum("together").over(Window.partitionBy(*leaf).orderBy("place", "id", "tokens"))
    reached = (
        last.withColumn("upto", running)
        .where("upto <= rest")
        .groupBy(*leaf)
        .agg(F.max(F.struct("place", "id", "tokens")).alias("reached"))
    )
    start = F.struct(
        (F.shiftleft("prefix", low) - 1).alias("place"), F.lit(2**63 - 1).alias("id"), F.lit(2**63 - 1).alias("tokens")
    )
    return state.join(reached, leaf, "left").select(*leaf, F.coalesce("reached", start).alias("cutoff"))


def mixed(
    docs: DataFrame,
    weights: Mapping[str, int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``_leaf`` (domain, lang, source), ``_tokens`` and ``_copies``: how often each document is taken.

    Null languages and sources are leaves named ``(none)``. A null or empty text has no tokens: it is taken with
    the whole epochs of its leaf, and with the prefix if its place lies there. Rows equal in id, tokens and leaf
    are taken alike. A null id has one place for all its rows. Columns of ``docs`` named ``_leaf``, ``_tokens`` or
    ``_copies`` are replaced. An empty table gives no rows.
    """
    placed = _placed(docs.drop("_leaf", "_tokens", "_copies"))
    leaf = list(LEVELS)
    keyed = settled(
        placed.select(
            "_leaf.*", F.col("doc_id").cast("long").alias("doc_id"), F.col("_tokens").alias("tokens")
        ),
        "mix-documents",
    )
    leaves = keyed.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"))
    plan = settled(budgets(leaves, weights, percent, max_epochs), "mix-budgets")
    least_id = F.lit(-(2**63))
    keys = keyed.join(plan.select(*leaf, "epochs"), leaf).select(
        *leaf,
        place_in_epoch(F.col("doc_id"), F.col("epochs"), seed).alias("place"),
        F.coalesce("doc_id", least_id).alias("id"),
        "tokens",
    )
    cut = plan.join(_cutoffs(settled(keys, "mix-places"), plan), leaf, "left").select(
        F.struct(*leaf).alias("_leaf"), F.col("epochs").alias("_epochs"), F.col("cutoff").alias("_cutoff")
    )
    at = F.struct(
        place_in_epoch(F.col("doc_id").cast("long"), F.col("_epochs"), seed).alias("place"),
        F.coalesce(F.col("doc_id").cast("long"), least_id).alias("id"),
        F.col("_tokens").alias("tokens"),
    )
    taken = F.coalesce((at <= F.col("_cutoff")).cast("long"), F.lit(0))
    joined = placed.join(settled(cut, "mix-cutoffs"), "_leaf")
    return joined.withColumn("_copies", F.col("_epochs") + taken).select(*placed.columns, "_copies")


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, domain, lang, source, tokens, copies)`` of every document."""
    kept = mixed(docs.select("doc_id", "text", "lang", "source"))
    return kept.select(
        F.col("doc_id").cast("long"), "_leaf.*", F.col("_tokens").alias("tokens"), F.col("_copies").alias("copies")
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it."""
    kept = mixed(docs).where("_copies > 0")
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*docs.columns)


def report_sql() -> str:
    """``report`` for DuckDB: the same tree of budgets, and each leaf sorted as a whole."""
    paths = ", ".join(f"('{path}', {weight})" for path, weight in WEIGHTS.items())

    def level(depth: int) -> str:
        keys = list(LEVELS[:depth])
        path = " || '/' || ".join(keys)
        up = keys[:-1]
        on = " AND ".join(f"n.{k} = u.{k}" for k in up) or "true"
        within = "PARTITION BY " + ", ".join(up) if up else ""
        return f"""
n{depth} AS (SELECT {", ".join(keys)}, sum(capacity) AS c FROM leaves GROUP BY ALL),
w{depth} AS (SELECT n.*, u.budget AS above, coalesce(weight, 1)::HUGEINT AS w, {path.replace("domain", "n.domain").replace("lang", "n.lang").replace("source", "n.source")} AS path
  FROM n{depth} n JOIN b{depth - 1} u ON {on} LEFT JOIN weights ON path = {path.replace("domain", "n.domain").replace("lang", "n.lang").replace("source", "n.source")}),
r{depth} AS (SELECT *,
    coalesce(sum(c) OVER ({within} ORDER BY c / nullif(w, 0) NULLS LAST, path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(w) OVER ({within} ORDER BY c / nullif(w, 0) NULLS LAST, path ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w{depth}),
f{depth} AS (SELECT *, w > 0 AND c * open <= (above - filled) * w AS is_full FROM r{depth}),
s{depth} AS (SELECT *, above - coalesce(sum(c) FILTER (is_full) OVER ({within}), 0) AS rest, coalesce(sum(w) FILTER (NOT is_full) OVER ({within}), 0) AS sharing FROM f{depth}),
b{depth} AS (SELECT {", ".join(keys)}, CASE WHEN is_full THEN c ELSE least(coalesce((w * rest) // nullif(sharing, 0), 0), c) END AS budget FROM s{depth})"""

    return f"""
WITH placed AS (
  SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
    CASE WHEN regexp_extract(source, '[0-9]{{1,2}}$') <> '' THEN 'd' || (regexp_extract(source, '[0-9]{{1,2}}$')::INT % 4) ELSE 'other' END AS domain,
    (coalesce(strlen(text), 0) + 3) // 4 AS tokens
  FROM documents),
weights(path, weight) AS (VALUES {paths}),
leaves AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, sum(tokens)::HUGEINT * {MAX_EPOCHS} AS capacity FROM placed GROUP BY ALL),
b0 AS (SELECT coalesce(sum(tokens), 0) * {BUDGET_PERCENT} // 100 AS budget FROM leaves),{",".join(level(d) for d in (1, 2, 3))},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM b3 JOIN leaves USING (domain, lang, source)),
ordered AS (SELECT p.*, epochs, rest, ('0x' || substr(md5('{SEED}' || '|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM placed p JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id NULLS FIRST, tokens) AS upto FROM ordered)
SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM summed"""
