"""Mixing sources to target weights by hierarchical budgets.

Leaves of a domain - language - source tree hold documents. A leaf can give
at most ``max_epochs`` times its tokens, a node the sum of its children. From
the root down each node splits its budget among its children in proportion to
their weights; what a child cannot use goes to its siblings. As a node's
budget never exceeds what lies below it, a shortage reaches an ancestor's
other children only when all siblings are full.

A leaf's budget is a number of whole epochs plus a token-prefix of the next
one, in the order of a hash of seed, epoch and document. The prefix ends at a
cut key: token sums per leaf and hash bucket find the bucket that holds it,
and only that bucket's rows are ordered, so a leaf with a third of all rows
is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logwise.llm.common import materialize

#: Words of ASCII white space separation; the token count of a text.
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a key that name its bucket (16^3 buckets a leaf).
BUCKET_DIGITS = 3


def count_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def weight_of(name: Column, weights: Mapping[str, int], default: int = 1) -> Column:
    """Weight of a node by its name; unlisted names have ``default``."""
    out = F.lit(default)
    for key, value in weights.items():
        out = F.when(name == key, F.lit(value)).otherwise(out)
    return out.cast("long")


def split_budget(nodes: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """Water-filling: adds ``budget`` to rows of (parent, child, cap, weight,
    total). Children are taken in order of cap / weight; those that reach
    their cap before the common level are full, the rest get level * weight.
    A child of weight 0 gets nothing.
    """
    ratio = F.col("cap") / F.col("weight")
    order = Window.partitionBy(*parent).orderBy("ratio", child)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    at = (
        nodes.where(F.col("weight") > 0)
        .withColumn("ratio", ratio)
        .withColumn("level", level)
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn("common", F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parent)))
    )
    share = F.floor(F.col("common") * F.col("weight")).cast("long")
    return at.withColumn(
        "budget", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", share))
    ).drop("ratio", "level", "full", "common")


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    target: int | None,
    max_epochs: int,
) -> DataFrame:
    """(levels..., tokens, budget) of leaves given as (levels..., tokens).

    ``weights`` has the relative weights of names per level (whole numbers;
    unlisted: 1). ``target`` is the total in tokens, None: as many as there
    are. One row per node and level; windows hold the children of a node.
    """
    leaves = leaves.withColumn("cap", F.col("tokens") * F.lit(max_epochs))
    tokens, most = leaves.agg(F.sum("tokens"), F.sum("cap")).first()
    total = min((tokens if target is None else target) or 0, most or 0)
    above = None
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", weight_of(F.col(level), weights.get(level, {})))
        nodes = nodes.join(above, path[:-1]) if depth else nodes.withColumn("total", F.lit(total).cast("long"))
        above = split_budget(nodes, path[:-1] or [F.lit(0)], level).select(*path, F.col("budget").alias("total"))
    return leaves.select(*levels, "tokens").join(above.withColumnRenamed("total", "budget"), list(levels), "left").select(
        *levels, "tokens", F.coalesce("budget", F.lit(0).cast("long")).alias("budget")
    )


def order_key(seed: int, epoch: Column, doc: Column) -> Column:
    """Place of a document in an epoch's order: a hex digest."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def leaf_plans(
    docs: DataFrame,
    levels: Sequence[str],
    id_col: str,
    token_col: str,
    weights: Mapping[str, Mapping[str, int]],
    target: int | None = None,
    max_epochs: int = 4,
    seed: int = 0,
) -> DataFrame:
    """One row per leaf: tokens, budget, whole epochs, and the cut key of the
    epoch that is taken in part (empty: none of it). ``docs`` should be a
    written table: it is read three times."""
    levels = list(levels)
    leaves = docs.groupBy(*levels).agg(F.sum(token_col).alias("tokens"))
    plan = leaf_budgets(leaves, levels, weights, target, max_epochs)
    whole = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long")
    plan = materialize(
        plan.withColumn("epochs", whole).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")),
        "mix-plan",
    )
    keyed = (
        docs.join(plan.where(F.col("rest") > 0).select(*levels, "epochs", "rest"), levels)
        .withColumn("_key", order_key(seed, F.col("epochs"), F.col(id_col)))
        .withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    )
    sums = keyed.groupBy(*levels, "rest", "_bucket").agg(F.sum(token_col).alias("_sum"))
    run = F.sum("_sum").over(Window.partitionBy(*levels).orderBy("_bucket"))
    edge = (
        sums.withColumn("_run", run)
        .where(F.col("_run") > F.col("rest"))
        .groupBy(*levels)
        .agg(F.min(F.struct("_bucket", (F.col("_run") - F.col("_sum")).alias("base"))).alias("_edge"))
        .select(*levels, F.col("_edge._bucket").alias("_bucket"), F.col("_edge.base").alias("_base"))
    )
    inside = keyed.join(edge, [*levels, "_bucket"])
    upto = F.col("_base") + F.sum(token_col).over(Window.partitionBy(*levels).orderBy("_key"))
    cuts = (
        inside.withColumn("_upto", upto)
        .groupBy(*levels)
        .agg(F.max(F.when(F.col("_upto") <= F.col("rest"), F.col("_key"))).alias("_last"), F.first("_bucket").alias("_b"))
        .select(*levels, F.coalesce("_last", "_b").alias("cut"))
    )
    return materialize(
        plan.join(cuts, levels, "left").select(
            *levels, "tokens", "budget", "epochs", F.coalesce("cut", F.lit("")).alias("cut")
        ),
        "mix-cuts",
    )


def take(docs: DataFrame, plan: DataFrame, levels: Sequence[str], id_col: str, seed: int = 0) -> DataFrame:
    """Rows of ``docs`` once per epoch they are taken in, with ``epoch``."""
    joined = docs.join(plan.select(*levels, "epochs", "cut"), list(levels))
    partial = order_key(seed, F.col("epochs"), F.col(id_col)) <= F.col("cut")
    times = F.col("epochs") + F.when(partial, 1).otherwise(0)
    return (
        joined.withColumn("_times", times)
        .where(F.col("_times") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1)))
        .drop("epochs", "cut", "_times")
    )


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    target: int | None = None,
    max_epochs: int = 4,
    seed: int = 0,
    whole_rows: bool = False,
) -> DataFrame:
    """A mixture of whole documents that meets the budgets.

    Result: id, domain, lang, source, n_tokens, epoch - one row per epoch in
    which a document is taken; with ``whole_rows`` all columns of ``docs``
    instead. A leaf's total is the longest prefix that fits its budget.
    Tokens are words (null text: 0); a leaf without tokens gives nothing.
    Null domain, language or source is the empty name, in the result too
    (with ``whole_rows`` the columns stay as they are). Repeated rows share a
    place in the order and are taken together. Extra columns never matter. An
    empty table gives no rows.
    """
    names = [("domain", domain), ("lang", F.col(lang_col)), ("source", F.col(source_col))]
    leaf = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in names]
    light = materialize(
        docs.select(F.col(id_col).alias("_id"), *leaf, count_words(F.col(text_col)).alias("n_tokens")), "mix-light"
    )
    levels = [n for n, _ in names]
    plan = leaf_plans(light, levels, "_id", "n_tokens", weights, target, max_epochs, seed)
    if not whole_rows:
        return take(light, plan, levels, "_id", seed).select(F.col("_id").alias(id_col), *levels, "n_tokens", "epoch")
    hidden = [f"_mix_{n}" for n in levels]
    rows = docs.withColumns(dict(zip(hidden, leaf, strict=True)))
    for n, h in zip(levels, hidden, strict=True):
        plan = plan.withColumnRenamed(n, h)
    taken = take(
        rows.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_id"), *hidden), plan, hidden, "_id", seed
    )
    return taken.select("_row.*")
