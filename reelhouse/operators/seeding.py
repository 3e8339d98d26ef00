"""Inserts that skip rows in conflict with a unique key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from reelhouse.operators.change import Change, like_table, not_yet_in
from reelhouse.operators.joins import hot_join, in_keys
from reelhouse.operators.numbering import assign_keys, number_rows
from reelhouse.sources.session import checkpointed, stored


def _filled(key: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in key])


def _leading(rows: DataFrame, keys: list[list[str]], row_id: str) -> DataFrame:
    """Rows that come first under every key in which they have no null."""
    firsts = [rows.where(_filled(k)).groupBy(*k).agg(F.min(row_id).alias(row_id)).select(row_id) for k in keys]
    wins = reduce(DataFrame.unionByName, firsts).groupBy(row_id).agg(F.count(F.lit(1)).alias("_wins"))
    needed = sum((F.when(_filled(k), 1).otherwise(0) for k in keys), start=F.lit(0))
    return rows.join(wins, row_id, "left").where(F.coalesce("_wins", F.lit(0)) == needed).drop("_wins")


def _settled_by_parity(chains: DataFrame) -> DataFrame:
    """(_id, _kept) of the rows (_id, _before) that lead to a row without a blocker.

    ``_before`` is the one row that can block a row, or null. A row goes in exactly if its
    blocker does not, so its fate is that of the row its chain starts with and the parity of
    its place. Pointers are doubled until they reach the start: a chain of n rows takes the
    logarithm of n in steps, each one join. Chains that start behind a row which is not in
    ``chains`` are left out.
    """
    first = F.isnull("_before")
    columns = ["_id", F.coalesce("_before", "_id").alias("_at"), (~first).alias("_odd"), first.alias("_ends")]
    count = Observation()
    state = stored(chains.select(*columns).observe(count, F.count_if(~F.col("_ends")).alias("open")))
    while count.get["open"]:
        step = state.select(F.col("_id").alias("_at"), F.col("_at").alias("_next"), F.col("_odd").alias("_more"), F.col("_ends").alias("_end"))
        moved = hot_join(state.where("not _ends"), step, ["_at"], "left").select(
            "_id",
            F.coalesce("_next", "_at").alias("_at"),
            (F.col("_odd") != F.coalesce("_more", F.lit(False))).alias("_odd"),
            F.coalesce("_end", F.lit(False)).alias("_ends"),
            F.isnotnull("_next").alias("_moved"),
        )
        both = state.where("_ends").withColumn("_moved", F.lit(True)).unionByName(moved)
        count = Observation()
        state = stored(both.observe(count, F.count_if(~F.col("_ends") & F.col("_moved")).alias("open"))).drop("_moved")
    return state.where("_ends").select("_id", (~F.col("_odd")).alias("_kept"))


def first_without_conflict(rows: DataFrame, keys: list[list[str]], row_id: str) -> DataFrame:
    """The rows that go in when they are tried one by one in ``row_id`` order.

    A row is refused when it shares a key with one that went in before; a refused row
    blocks nobody. With one key the first row of each key goes in. With several, rounds
    settle the open rows. Of each key value a round looks at the first two open rows. A row
    that is first under all its keys goes in. One that is first or second under all of
    them, and second always behind the same row, has that row as its only blocker; chains
    of such rows are settled at once, see :func:`_settled_by_parity`. Rows that share a key
    with one that went in are refused, and the rest is judged again. One to three rounds
    are usual, and a chain in which each row blocks the next is settled in the logarithm of
    its length. Rows with several open blockers each wait for a later round: where long
    chains run through such rows, the rounds grow with the number of these in a row.

    A round's outcome is stored once, and the number of rows still open is counted
    while it is written.
    """
    if len(keys) == 1:
        return _leading(rows, keys, row_id)

    def value(i: int, key: list[str]) -> Column:
        texts = F.array(*[F.col(c).cast("string") for c in key])
        return F.when(_filled(key), F.struct(F.lit(i).alias("key"), texts.alias("value")))

    values = F.array_compact(F.array(*[value(i, k) for i, k in enumerate(keys)]))
    every = rows.select(F.col(row_id).alias("_id"), values.alias("_values"))
    open_rows = every.where(F.size("_values") > 0)
    settled = [every.where(F.size("_values") == 0).select("_id")]
    by_value = Window.partitionBy("_value").orderBy("_id")
    left = 1
    while left:
        pairs = open_rows.select("_id", "_values", F.explode("_values").alias("_value"))
        # Each task sends at most two rows of a value, however many it has.
        two = pairs.select("_id", "_value", F.size("_values").alias("_keys")).withColumn("_place", F.row_number().over(by_value))
        two = two.where("_place <= 2").withColumn("_before", F.lag("_id").over(by_value))
        known = two.groupBy("_id", "_keys").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_before").alias("_before"), F.max("_before").alias("_other")
        )
        chains = known.where("_n = _keys and _before <=> _other").select("_id", "_before")
        kept = _settled_by_parity(chains).where("_kept").select("_id")
        taken = open_rows.join(kept, "_id").select(F.explode("_values").alias("_value"), F.col("_id").alias("_by"))
        judged = (
            hot_join(pairs, taken, ["_value"], "left")
            .groupBy("_id", "_values")
            .agg(F.bool_or(F.col("_by") == F.col("_id")).alias("_kept"), F.count("_by").alias("_met"))
        )
        count = Observation()
        judged = stored(judged.observe(count, F.count_if(F.col("_met") == 0).alias("open")))
        settled.append(judged.where("_kept").select("_id"))
        open_rows = judged.where("_met = 0").select("_id", "_values")
        left = count.get["open"]
    kept = reduce(DataFrame.unionByName, settled)
    return rows.join(kept.withColumnRenamed("_id", row_id), row_id, "left_semi")


_FEW = 100_000  # rows of a batch whose keys are sent to the target, not the target's keys to them


def _open_to(rows: DataFrame, target: DataFrame, keys: list[list[str]], row_id: str) -> tuple[DataFrame, DataFrame]:
    """The rows that meet no key of the target nor of another row, and those that only meet other rows.

    Of each key the values that the target or several rows hold are counted out, and the rows
    are marked by these alone. The values of a large batch and of the target go through one
    aggregate, which holds one row a value and task however often it occurs.
    """
    few = rows.count() <= _FEW
    marked = rows
    for i, key in enumerate(keys):
        held = target.select(*key)
        held = (in_keys(held, rows, key) if few else held).select(*key, F.lit(0).alias("_mine"), F.lit(1).alias("_theirs"))
        values = rows.select(*key, F.lit(1).alias("_mine"), F.lit(0).alias("_theirs")).unionByName(held).where(_filled(key))
        shared = values.groupBy(*key).agg(F.sum("_mine").alias("_mine"), F.max("_theirs").alias("_theirs"))
        shared = shared.where("_mine > 1 or (_mine = 1 and _theirs = 1)").select(*key, (F.col("_theirs") == 1).alias(f"_taken{i}"))
        marked = hot_join(marked, shared, key, "left")
    marks = [F.col(f"_taken{i}") for i in range(len(keys))]
    taken = reduce(Column.__or__, [F.coalesce(m, F.lit(False)) for m in marks])
    alone = reduce(Column.__and__, [m.isNull() for m in marks])
    marked = stored(marked.where(~taken & F.col(row_id).isNotNull()).select(*rows.columns, alone.alias("_alone")))
    return marked.where("_alone").drop("_alone"), marked.where("not _alone").drop("_alone")


def insert_or_skip(
    target: DataFrame,
    rows: DataFrame,
    unique_keys: list[list[str]],
    id_column: str | None = None,
    row_id: str = "row_id",
) -> Change:
    """``INSERT … ON CONFLICT DO NOTHING``: skip rows that meet a unique key in the target or earlier in the batch.

    Without a ``row_id`` column the batch is taken in order of its values. New ids are
    given in that order after the largest one. With no unique key everything goes in.
    """
    for column in {c for key in unique_keys for c in key if c not in rows.columns}:
        rows = rows.withColumn(column, F.lit(None).cast(target.schema[column].dataType))
    if row_id not in rows.columns:
        rows = number_rows(rows, list(rows.columns), name=row_id)
    else:
        rows = checkpointed(rows)
    if len(unique_keys) > 1:
        alone, others = _open_to(rows, target, unique_keys, row_id)
        rows = alone.unionByName(first_without_conflict(others, unique_keys, row_id))
    for key in unique_keys if len(unique_keys) == 1 else []:
        rows = first_without_conflict(not_yet_in(rows, target, key), unique_keys, row_id)
    if id_column is not None:
        rows = assign_keys(rows, target, id_column, [row_id], unique=True)
    new = like_table(rows, target)
    return Change(target.unionByName(new), new)
