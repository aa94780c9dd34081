"""Row-level change: merge, delete, update, and the change feed between versions.

Nothing here gathers a group into one task: copies of a row are counted by partial aggregation, and every
join has a deduplicated or key-unique side, so that a hot key splits under adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIT = "__hit"
COPIES_PER_STEP = 100_000


class DuplicateSourceKey(ValueError):
    """Two source rows would act on the same target row."""


def _check_unique(source: DataFrame, on: Sequence[str]) -> None:
    twice = source.dropna(subset=list(on)).groupBy(*on).count().filter("count > 1").limit(1).collect()
    if twice:
        raise DuplicateSourceKey(f"source has the key {twice[0].asDict()} more than once")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: str | dict[str, str] | None = "update",
    matched_if: str | None = None,
    not_matched: str | None = "insert",
) -> DataFrame:
    """Rows of ``target`` after merging ``source`` on equal keys. NULL keys never match.

    ``matched``: ``"update"`` (all shared columns), a dict ``{column: expression}`` over ``t.`` and ``s.``,
    ``"delete"`` or ``None``. ``matched_if`` is an extra condition over ``t.`` and ``s.``.
    """
    _check_unique(source, on)
    keys = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on]
    found = source.withColumn(HIT, F.lit(True))
    joined = target.alias("t").join(found.alias("s"), keys, "left")
    condition = F.expr(matched_if) if matched_if else F.lit(True)
    acts = F.coalesce(F.col(f"s.{HIT}") & condition, F.lit(False))

    if matched == "delete":
        kept = joined.filter(~acts).select("t.*")
    elif matched is None:
        kept = target
    else:
        if matched == "update":
            news = {c: F.col(f"s.{c}") for c in target.columns if c in source.columns and c not in on}
        else:
            news = {c: F.expr(e) for c, e in matched.items()}
        types = {f.name: f.dataType for f in target.schema.fields}
        kept = joined.select(
            *[
                F.when(acts, news[c].cast(types[c])).otherwise(F.col(f"t.{c}")).alias(c) if c in news else F.col(f"t.{c}")
                for c in target.columns
            ]
        )
    if not_matched != "insert":
        return kept
    # Keys of the source that the target holds: a small source is broadcast and the target is not shuffled.
    held = target.select(*on).join(source.select(*on), list(on), "left_semi").distinct()
    fresh = source.join(held, list(on), "left_anti")
    inserted = fresh.select(
        *[
            (F.col(f.name) if f.name in source.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    return kept.unionByName(inserted)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where the condition holds; where it is NULL they stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def update_where(df: DataFrame, values: dict[str, Column], condition: Column) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: F.when(condition, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
    )


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times. A row of very many copies is cut into steps, which are dealt out over tasks."""
    steps = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / COPIES_PER_STEP))
    left = F.least(F.lit(COPIES_PER_STEP), F.col(times) - F.col("__step") * COPIES_PER_STEP).cast("int")
    many = F.col(times) > COPIES_PER_STEP
    few = df.filter(~many).withColumn("__step", F.lit(0).cast("long"))
    dealt = df.filter(many).withColumn("__step", F.explode(steps)).repartition("__step")
    return (
        few.unionByName(dealt)
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), left)))
        .drop("__step", "__copy", times)
    )


def table_changes(
    states: Sequence[tuple[int | None, DataFrame | None]], key: Sequence[str] | None = None, copies: str | None = None
) -> DataFrame:
    """Changes between consecutive states ``[(version, rows), ...]`` that share one schema.

    The first state is the base; ``(None, None)`` stands for "nothing yet". Result: ``snapshot_id``, ``change_type``
    (insert, delete, update_preimage, update_postimage) and the data columns. With ``key``, a key that loses one
    row and gains one in the same version is an update; otherwise rows are deleted and inserted. With ``copies``, equal
    changes are one row, and that column says how many they are.

    All states are read once and meet in a single aggregation on the whole row, however many there are.
    """
    frames = [(df, [i]) for i, (_, df) in enumerate(states) if df is not None]
    return changes_of(frames, [v for v, _ in states[1:]], key, copies)


def changes_of(
    frames: Sequence[tuple[DataFrame, Sequence[int]]], steps: Sequence[int], key: Sequence[str] | None = None, copies: str | None = None
) -> DataFrame:
    """Changes as in :func:`table_changes`, from rows that several states may hold: ``[(rows, numbers of states), ...]``.

    State 0 is the base, and ``steps`` are the versions of states 1, 2 and so on. Rows that all states hold may be left out:
    they are no change.
    """
    columns = frames[0][0].columns
    tagged = [df.withColumn("__states", F.array(*[F.lit(i) for i in members])) for df, members in frames]
    everything = reduce(DataFrame.unionByName, tagged)
    held = [F.count_if(F.array_contains("__states", i)).alias(f"__n{i}") for i in range(len(steps) + 1)]
    counted = everything.groupBy(*columns).agg(*held)
    deltas = F.array(
        *[
            F.struct(F.lit(v).cast("long").alias("snapshot_id"), (F.col(f"__n{i}") - F.col(f"__n{i - 1}")).alias("delta"))
            for i, v in enumerate(steps, start=1)
        ]
    )
    moved = (
        counted.withColumn("__d", F.explode(F.filter(deltas, lambda d: d["delta"] != 0)))
        .select(F.col("__d.snapshot_id").alias("snapshot_id"), F.col("__d.delta").alias("__delta"), *columns)
    )
    plain = F.when(F.col("__delta") > 0, "insert").otherwise("delete")
    if key:
        ends = moved.groupBy("snapshot_id", *key).agg(
            F.sum(F.when(F.col("__delta") > 0, F.col("__delta"))).alias("__in"),
            F.sum(F.when(F.col("__delta") < 0, -F.col("__delta"))).alias("__out"),
        )
        replaced = ends.filter("__in = 1 AND __out = 1").select("snapshot_id", *key, F.lit(True).alias(HIT))
        same = reduce(
            lambda a, b: a & b,
            [F.col(f"m.{k}").eqNullSafe(F.col(f"r.{k}")) for k in key],
            F.col("m.snapshot_id") == F.col("r.snapshot_id"),
        )
        moved = moved.alias("m").join(replaced.alias("r"), same, "left").select("m.*", f"r.{HIT}")
        image = F.when(F.col("__delta") > 0, "update_postimage").otherwise("update_preimage")
        kind = F.when(F.col(HIT), image).otherwise(plain)
    else:
        kind = plain
    labelled = moved.select("snapshot_id", kind.alias("change_type"), F.abs("__delta").alias("__times"), *columns)
    return labelled.withColumnRenamed("__times", copies) if copies else _repeat(labelled, "__times")


def change_summary(feed: DataFrame, copies: str | None = None) -> DataFrame:
    """Per version: rows inserted, deleted and updated, and the list of what happened.

    ``copies`` names the column of a feed that counts equal changes instead of repeating them.
    """
    n = F.col(copies) if copies else F.lit(1)

    def rows(kind: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("change_type") == kind, n)), F.lit(0)).cast("long").alias(name)

    counts = feed.groupBy("snapshot_id").agg(
        rows("insert", "inserted"), rows("delete", "deleted"), rows("update_postimage", "updated")
    )
    words = [F.when(F.col(c) > 0, c) for c in ("inserted", "deleted", "updated")]
    return counts.withColumn("changes", F.concat_ws(",", *words))
