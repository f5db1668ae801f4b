"""Operators on keyed tables: picks, merges, diffs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.values import licence_rank, stricter

REPLACE, MERGE, KEEP, STRICTER, PRESERVE = "replace", "merge", "keep", "stricter", "preserve"


#: The columns of a financial record that are overwritten, and its key, licence and guard. All others merge.
FINANCIAL_KEY = ["code", "fiscal_period_end", "disclosure_type", "consolidated"]
FINANCIAL_OVERWRITE = ("source", "fetched_at", "quality")
FINANCIAL_LICENCE, FINANCIAL_GUARD = "license_tag", "disclosed_at"
UNKNOWN_SCOPE = "不明"
PROVENANCE = ["source", "license_tag", "data_date", "fetched_at", "quality"]


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. A limit of one for each key goes before the shuffle as well, which sorts once."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def pick_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in an order that leaves no ties."""
    return _ranked(df, keys, [c.asc() for c in order])


def least_of_each(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """What pick_first gives, by a grouped minimum: with many rows a key, each task hands on one row of each, and none is sorted
    after the shuffle. With nearly one row a key, pick_first is cheaper."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def pick_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _ranked(df, keys, [c.desc() for c in order])


def merge_upsert(old: DataFrame, new: DataFrame, keys: list[str], policy: dict[str, str] | None = None, guard: str | None = None, scope: str | None = None) -> DataFrame:
    """old with new merged in by key, each column under its policy: replace (default), merge (new unless null), keep
    (old once there is one), stricter (licence tags), preserve (old; null for new rows). With a guard column an older or
    null incoming value leaves the row as it is. With a scope column, merge holds only where both scopes are equal. new
    has one row per key (see fold_batch). Columns that new lacks are preserved, those that only new has are added."""
    policy = policy or {}
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("_o"), F.lit(True).alias("_in_old"))
    n = new.select(*keys, F.struct(*[c for c in new.columns if c not in keys]).alias("_n"), F.lit(True).alias("_in_new"))
    joined = o.join(n, keys, "full_outer")
    both = F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull()
    taken = F.col("_in_new").isNotNull()
    if guard:
        passes = (F.col("_n")[guard] >= F.col("_o")[guard]) | F.col("_o")[guard].isNull()
        taken = taken & (~both | F.coalesce(passes, F.lit(False)))
    out = []
    if unknown := [c for c in (*policy, guard, scope) if c is not None and c not in {*old.columns, *new.columns} - set(keys)]:
        raise ValueError(f"no such columns beside the key: {', '.join(unknown)}")
    for c in [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]:
        a, b = (F.col(s)[c] if c in df.columns else F.lit(None) for s, df in (("_o", old), ("_n", new)))
        kind = policy.get(c, REPLACE if c in new.columns else PRESERVE)
        if kind == MERGE:
            merged = F.coalesce(b, a)
            value = merged if scope is None else F.when(F.col("_n")[scope].eqNullSafe(F.col("_o")[scope]), merged).otherwise(b)
        else:
            value = {REPLACE: b, KEEP: a, STRICTER: stricter(b, a), PRESERVE: a}[kind]
        inserted = F.lit(None) if kind == PRESERVE else b
        out.append(F.when(~taken, a).when(both, value).otherwise(inserted).alias(c))
    return joined.select(*keys, *out)


def financial_policy(columns: list[str]) -> dict[str, str]:
    """What each column of a financial record does when a later disclosure of its key comes."""
    rest = [c for c in columns if c not in FINANCIAL_KEY]
    return {c: REPLACE if c in FINANCIAL_OVERWRITE else STRICTER if c == FINANCIAL_LICENCE else MERGE for c in rest}


def apply_in_order(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column], policy: dict[str, str] | None = None, guard: str | None = None, scope: str | None = None) -> DataFrame:
    """old after each row of new has been merged in by key, one after another in an order without ties: what merge_upsert gives for
    one row at a time. old has one row per key; keys are compared null for null.

    A row is taken if the guard so far is null or not above its own. Rows that were not taken have a lower guard or none, so the guard
    so far is the highest of all rows before, taken or not, and one window over the batch tells which rows are taken. What they come to
    is one grouping over the same exchange: the last value, the last that isn't null (under a scope: since the scope last changed), the
    first, or the strictest."""
    policy = policy or {}
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    if unknown := [c for c in (*policy, guard, scope) if c is not None and c not in columns]:
        raise ValueError(f"no such columns beside the key: {', '.join(unknown)}")
    rows = new.select("*", F.struct(F.lit(1).alias("_new"), F.struct(*order).alias("_order")).alias("_at"))
    first = F.struct(F.lit(0).alias("_new"), F.lit(None).cast(rows.schema["_at"].dataType["_order"].dataType).alias("_order"))
    rows = old.withColumn("_at", first).unionByName(rows, allowMissingColumns=True)
    by_key = Window.partitionBy(*keys).orderBy("_at")
    if guard:
        so_far = F.max(guard).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn("_so_far", so_far).filter(F.col("_so_far").isNull() | (F.col(guard) >= F.col("_so_far")))
    run = F.lit(0)
    if scope:
        changed = F.when(F.col(scope).eqNullSafe(F.lag(scope).over(by_key)), 0).otherwise(1)
        rows = rows.withColumn("_changed", changed).withColumn("_run", F.sum("_changed").over(by_key))
        run = F.col("_run")
    out = []
    for c in columns:
        kind = policy.get(c, REPLACE if c in new.columns else PRESERVE)
        if kind == MERGE:
            known = F.max(F.when(F.col(c).isNotNull(), F.struct(run.alias("run"), F.col("_at"), F.col(c).alias("value"))))
            value = F.when(known["run"] == F.max(run), known["value"])
        elif kind == STRICTER:
            value = F.max_by(c, F.struct(licence_rank(F.col(c)), "_at"))
        elif kind == KEEP:
            value = F.min_by(c, "_at")
        else:
            value = F.max_by(c, F.when(F.col("_at._new") == 0, F.col("_at")) if kind == PRESERVE else F.col("_at"))
        out.append(value.alias(c))
    return rows.groupBy(*keys).agg(*out)


def merge_financials(old: DataFrame, new: DataFrame, order: list[Column]) -> DataFrame:
    """Financial records merged in one after another under the disclosure's time; a scope that isn't known is a key of its own."""
    known = lambda df: df.withColumn("consolidated", F.coalesce(F.nullif("consolidated", F.lit("")), F.lit(UNKNOWN_SCOPE)))
    new = known(new)
    return apply_in_order(known(old), new, FINANCIAL_KEY, order, financial_policy(new.columns), FINANCIAL_GUARD)


def replace_by(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of new in place of old ones with the same key, of several the last, but for columns to keep. Rows without a whole key
    are skipped. Prices go by code and data_date, disclosures by doc_id, raw files by sha256 with first_fetched_at kept."""
    for k in keys:
        new = new.filter(F.col(k).isNotNull())
    return merge_upsert(old, pick_last(new, keys, order).select(*[c for c in new.columns if c in old.columns]), keys, dict.fromkeys(keep, KEEP))


def fold_batch(new: DataFrame, keys: list[str], order: list[Column], merge: list[str]) -> DataFrame:
    """One row per key of a batch: the last value of each column, the last that isn't null for those in merge."""
    at = F.struct(*order)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)) if c in merge else F.max_by(c, at)
    return new.groupBy(*keys).agg(*[last(c).alias(c) for c in new.columns if c not in keys])


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of new whose key old has with other values in the columns."""
    before = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in columns])
    differ = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in columns])
    return new.join(before, keys).filter(differ)


def diff_declared(declared: DataFrame, observed: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys and status: missing (only declared), orphan (only observed), mismatched."""
    d = declared.select(*keys, F.col(column).alias("_d"), F.lit(True).alias("_in_d"))
    o = observed.select(*keys, F.col(column).alias("_o"), F.lit(True).alias("_in_o"))
    status = F.when(F.col("_in_o").isNull(), "missing").when(F.col("_in_d").isNull(), "orphan").when(~F.col("_d").eqNullSafe(F.col("_o")), "mismatched")
    return d.join(o, keys, "full_outer").select(*keys, status.alias("status")).filter("status is not null")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """How many rows of child have a key that parent lacks; null keys don't count."""
    keyed = child.filter(F.col(child_key).isNotNull()).select(F.col(child_key).alias("k"))
    return keyed.join(parent.select(F.col(parent_key).alias("k")), "k", "left_anti").agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(name).alias("child"), "orphans")


def departed(current: DataFrame, fetched: DataFrame, key: str, least_coverage: float = 0.5) -> DataFrame:
    """Keys of current that fetched lacks; none where the fetched keys are fewer than the given share of the current ones. Both
    sides meet once, in one grouped pass over the keys."""
    sides = current.select(key, F.lit(1).alias("_c"), F.lit(0).alias("_f")).unionByName(fetched.select(key, F.lit(0).alias("_c"), F.lit(1).alias("_f")))
    keys = sides.groupBy(key).agg(F.max("_c").alias("_c"), F.max("_f").alias("_f"))
    share = keys.agg((F.sum("_f") / F.sum("_c")).alias("_share"))
    return keys.filter("_c = 1 and _f = 0").join(F.broadcast(share), F.col("_share") >= least_coverage).select(key)


def merge_series(existing: DataFrame, points: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Both sets of points, new ones in place of old ones with the same keys, null for null. Of new points with one key the last
    stays, in the given order or that of all their columns. Both sides meet in one grouping, which combines before the shuffle."""
    rest = [c for c in points.columns if c not in keys]
    last = F.struct(*order) if order else F.struct(*points.columns)
    new = points.select(*keys, F.lit(1).alias("_new"), last.alias("_order"), F.struct(*rest).alias("_point"))
    old = existing.select(*keys, F.lit(0).alias("_new"), F.lit(None).cast(new.schema["_order"].dataType).alias("_order"), F.struct(*rest).alias("_point"))
    best = F.max_by("_point", F.struct("_new", "_order"))
    return old.unionByName(new).groupBy(*keys).agg(best.alias("_point")).select(*keys, "_point.*").select(*points.columns)


def same_sets(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """What only one of two sets of rows has: the columns and `side`, declared or observed. No rows: the sets are equal."""
    return declared.exceptAll(observed).distinct().withColumn("side", F.lit("declared")).unionByName(observed.exceptAll(declared).distinct().withColumn("side", F.lit("observed")))


def with_provenance(records: DataFrame, provenance: str = "provenance") -> DataFrame:
    """A struct of provenance as columns of its own."""
    return records.select(*[c for c in records.columns if c != provenance], *[F.col(provenance)[c].alias(c) for c in PROVENANCE])


def stored_form(records: DataFrame) -> DataFrame:
    """Dates as ISO text and times as epoch seconds, as the row store keeps them; other columns as they are, in their order."""
    as_stored = {"date": lambda c: F.date_format(c, "yyyy-MM-dd"), "timestamp": F.unix_seconds}
    return records.select(*[as_stored[kind](F.col(c)).alias(c) if kind in as_stored else F.col(c) for c, kind in records.dtypes])


def look_up(rows: DataFrame, key: str, master: DataFrame, master_key: str, value: str, alias: str) -> DataFrame:
    """rows with the master's value for their key, null where it has none; keys are few beside rows, so only they are looked up."""
    known = rows.select(key).distinct().join(master.select(F.col(master_key).alias(key), F.col(value).alias(alias)), key)
    return rows.join(known, key, "left")


def lineage(rows: DataFrame, raw: DataFrame, key: str, raw_key: str | None = None) -> DataFrame:
    """rows with the raw files that they come from, joined by digest or document id."""
    return rows.join(raw.select(F.col(raw_key or key).alias(key), *[F.col(c).alias(f"raw_{c}") for c in raw.columns if c != (raw_key or key)]), key)


def regressions(old: DataFrame, new: DataFrame, series: list[str], element: list[str]) -> DataFrame:
    """Per series: how many elements of old are missing from new, and both sizes; only series that lost something. Elements are
    compared null for null."""
    had = old.select(*series, *element)
    has = new.select(*series, *element)
    both = had.select("*", F.lit(1).alias("_had"), F.lit(0).alias("_has")).unionByName(has.select("*", F.lit(0).alias("_had"), F.lit(1).alias("_has")))
    each = both.groupBy(*series, *element).agg(F.sum("_had").alias("_had"), F.sum("_has").alias("_has"))
    lost = F.sum(F.when(F.col("_has") == 0, F.col("_had")).otherwise(0))
    sizes = each.groupBy(*series).agg(F.sum("_had").alias("old_size"), F.sum("_has").alias("new_size"), lost.alias("lost"))
    return sizes.filter("old_size > 0 and (lost > 0 or new_size < old_size)")
