"""Change data capture: current state (SCD1), full history (SCD2), upserts.

Every operator is a DataFrame -> DataFrame function. Ordering is always
explicit: a sequence column decides, and a tiebreak column settles equal
sequences (smallest tiebreak = first seen), so results do not depend on how
the input was split into files or partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.util import names
from strata.operators.dedup import dedup_latest, latest_order, top_n_per_key
from strata.operators.ordered import auto_chunk_width, last_before_in_key, materialize, next_in_key, time_chunk

START, END = "__START_AT", "__END_AT"


def _pred(p) -> Column | None:
    if p is None:
        return None
    return F.expr(p) if isinstance(p, str) else p


def _differs(cols: list[str], left: str, right: str) -> Column:
    """NULL-safe 'row changed' test over several columns."""
    if not cols:
        return F.lit(False)
    out = None
    for c in cols:
        d = ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        out = d if out is None else (out | d)
    return out


# ---------------------------------------------------------------- SCD type 1

def scd1(events: DataFrame, keys, seq: str, tiebreak=None, delete_when=None,
         except_cols=()) -> DataFrame:
    """One row per key holding its latest event (late events cannot win).

    If the winning event matches ``delete_when`` the key is absent.
    """
    latest = dedup_latest(events, keys, seq, tiebreak)
    dw = _pred(delete_when)
    if dw is not None:
        latest = latest.filter(~F.coalesce(dw, F.lit(False)))
    return latest.drop(*except_cols)


def apply_changes(events: DataFrame, keys, seq: str, change_type: str = "_change_type",
                  tiebreak=None) -> DataFrame:
    """Insert/update/delete feed -> current state, safe against out-of-order events."""
    return scd1(events, keys, seq, tiebreak, delete_when=F.lower(F.col(change_type)) == "delete",
                except_cols=(change_type,))


# ---------------------------------------------------------------- SCD type 2

def scd2(events: DataFrame, keys, seq: str, tiebreak=None, delete_when=None, except_cols=(),
         chunk_width: str = "auto", track: list[str] | None = None, checkpoint: bool = True) -> DataFrame:
    """Full history: one version per event, valid from its sequence to the next.

    ``__START_AT`` = sequence; ``__END_AT`` = next sequence of the key (NULL =
    current). A delete event closes the open version and adds none. An event
    that repeats (same key and sequence) counts once (smallest tiebreak). With
    ``track`` given, consecutive events equal on those columns collapse into
    one version. The "next sequence" is computed per (key, time chunk) so a hot
    key is spread over many tasks; ``chunk_width="auto"`` sizes the chunks from
    the data (at most ~2M rows each). ``checkpoint`` materializes the
    deduplicated events once (the chunked lead reads them twice).
    """
    keys = names(keys)
    ev = events.filter(F.col(seq).isNotNull())
    ev = dedup_latest(ev, keys + [seq], F.lit(0), tiebreak)  # one event per (key, seq)
    dw = _pred(delete_when)
    ev = ev.withColumn("__is_delete", F.coalesce(dw, F.lit(False)) if dw is not None else F.lit(False))
    if checkpoint:
        ev = materialize(ev)
    if chunk_width == "auto":
        chunk_width = auto_chunk_width(ev, keys, seq)
    chunk = time_chunk(F.col(seq), chunk_width)
    if track:
        ev = _collapse_unchanged(ev, keys, seq, track, chunk)
    ev = next_in_key(ev, keys, [seq], seq, END, chunk)
    out = (ev.filter(~F.col("__is_delete"))
             .withColumn(START, F.col(seq))
             .drop("__is_delete", *except_cols))
    return out


def _collapse_unchanged(ev: DataFrame, keys, seq, track, chunk) -> DataFrame:
    """Drop events equal (on ``track``) to the previous event of the same key."""
    sig = F.sha2(F.to_json(F.struct(*[F.col(c) for c in track], F.col("__is_delete"))), 256)
    d = ev.withColumn("__sig", sig).withColumn("__neg_seq", -F.unix_micros(F.col(seq).cast("timestamp")))
    # previous signature = next in descending order
    prev = next_in_key(d, keys, ["__neg_seq"], "__sig", "__prev_sig", -chunk)
    return (prev.filter(F.col("__prev_sig").isNull() | (F.col("__prev_sig") != F.col("__sig")))
                .drop("__sig", "__neg_seq", "__prev_sig"))


def current_rows(history: DataFrame, end_col: str = END) -> DataFrame:
    return history.filter(F.col(end_col).isNull())


def versions_as_of(history: DataFrame, as_of, start_col: str = START, end_col: str = END) -> DataFrame:
    """State of an SCD2 table at a past instant."""
    t = F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of
    return history.filter((F.col(start_col) <= t) & (F.col(end_col).isNull() | (F.col(end_col) > t)))


def scd3(events: DataFrame, keys, seq: str, column: str, tiebreak=None,
         previous_col: str | None = None) -> DataFrame:
    """Latest row per key plus the value ``column`` had in the event before it."""
    keys = names(keys)
    prev_name = previous_col or f"previous_{column}"
    top2 = top_n_per_key(events, keys, latest_order(seq, tiebreak), 2, rank_col="__rk")
    prev = top2.filter(F.col("__rk") == 2).select(*keys, F.col(column).alias(prev_name))
    cur = top2.filter(F.col("__rk") == 1).drop("__rk")
    return cur.join(prev, on=keys, how="left")


# ---------------------------------------------------------------- upsert (MERGE)

@dataclass
class UpsertResult:
    table: DataFrame        # the new target
    actions: DataFrame      # one row per output row with its action (insert/update/unchanged/kept/delete)

    def metrics(self) -> DataFrame:
        """(num_inserted_rows, num_updated_rows, num_deleted_rows) as one row."""
        a = F.col("_action")
        return self.actions.agg(
            F.count_if(a == "insert").alias("num_inserted_rows"),
            F.count_if(a == "update").alias("num_updated_rows"),
            F.count_if(a == "delete").alias("num_deleted_rows"),
        )


def upsert(target: DataFrame, source: DataFrame, keys, update_when: list[str] | None = None,
           stamp_col: str | None = None, stamp=None, delete_missing: bool = False,
           evolve: bool = False, assert_unique: bool = True) -> UpsertResult:
    """MERGE without a transaction log: full outer join on the key, then pick.

    matched and changed (NULL-safe on ``update_when``, default all non-key
    columns) -> source values (+ stamp); matched and equal -> target row;
    source only -> insert; target only -> kept, or dropped with
    ``delete_missing`` (WHEN NOT MATCHED BY SOURCE THEN DELETE). ``source``
    must hold one row per non-NULL key (deduplicate first); with
    ``assert_unique`` (default) the job fails otherwise instead of emitting
    duplicates. With ``evolve`` new source columns are added to the target.
    """
    keys = names(keys)
    if evolve:
        missing_t = [c for c in source.columns if c not in target.columns]
        for c in missing_t:
            target = target.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
    cols = [c for c in target.columns]
    data_cols = [c for c in cols if c not in keys and c != stamp_col]
    compare = update_when if update_when is not None else [c for c in data_cols if c in source.columns]
    s = source.select(*[c for c in source.columns if c in cols]).withColumn("__in_s", F.lit(True))
    if assert_unique:
        # Group the source by key once: the count proves uniqueness, and the join reuses
        # this hash partitioning by key, so the check adds no shuffle of its own.
        vals = [c for c in s.columns if c not in keys]
        s = (s.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*vals)).alias("__v"))
              .select(*keys, "__v.*", "__n"))
    t = target.withColumn("__in_t", F.lit(True))
    j = t.alias("t").join(s.alias("s"), on=keys, how="full_outer")
    in_s, in_t = F.col("s.__in_s").isNotNull(), F.col("t.__in_t").isNotNull()
    changed = in_s & in_t & _differs(compare, "t", "s")
    action = F.when(in_s & ~in_t, F.lit("insert"))
    if assert_unique:
        # several source rows for one key is an error for MERGE (NULL keys never match)
        action = F.when(F.col("s.__n") > 1, F.raise_error(F.lit(f"MERGE: several source rows share a key of {keys} (or a NULL key)")))\
                  .when(in_s & ~in_t, F.lit("insert"))
    action = (action
               .when(changed, F.lit("update"))
               .when(in_s & in_t, F.lit("unchanged"))
               .otherwise(F.lit("delete" if delete_missing else "kept")))
    take_s = in_s & (~in_t | changed)
    stamp_val = None
    if stamp_col:
        stamp_val = F.lit(stamp).cast(target.schema[stamp_col].dataType) if not isinstance(stamp, Column) else stamp
    out_cols = []
    for c in cols:
        if c in keys:
            out_cols.append(F.col(c))
        elif c == stamp_col:
            out_cols.append(F.when(take_s, stamp_val).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in s.columns:
            out_cols.append(F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out_cols.append(F.col(f"t.{c}").alias(c))
    actions = j.select(*out_cols, action.alias("_action"))
    table = actions.filter(F.col("_action") != "delete").drop("_action")
    return UpsertResult(table, actions)


def merge_into(spark, path: str, source: DataFrame, keys, n_buckets: int, change_id, **upsert_kw) -> dict:
    """MERGE into a key-bucketed parquet table, touching only the source's buckets.

    ``upsert_kw`` are the options of ``upsert``. With ``delete_missing`` every bucket
    is read (a full synchronisation has to see the whole target). Returns the
    inserted / updated / deleted counts, observed on the write itself.
    """
    from pyspark.sql import Observation

    from strata.operators import buckets as B
    keys = names(keys)
    source = B.with_stored_keys(spark, path, source, keys, n_buckets)
    s = B.with_bucket(source, keys, n_buckets).persist()
    try:
        ids = None if upsert_kw.get("delete_missing") else B.touched_buckets(s)
        t = B.read_buckets(spark, path, ids)
        read = ids if ids is not None or t is None else B.touched_buckets(t)
        if t is None:
            B.record_bucketing(spark, path, source, keys, n_buckets)
            t = s.limit(0).drop(B.BUCKET)
            for c in (upsert_kw.get("stamp_col"),):
                if c and c not in t.columns:
                    t = t.withColumn(c, F.lit(None).cast("timestamp_ntz"))
        else:
            t = t.drop(B.BUCKET)
        res = upsert(t, s.drop(B.BUCKET), keys, **upsert_kw)
        obs = Observation(f"merge_{change_id}")
        a = F.col("_action")
        out = (res.actions.observe(obs, F.count_if(a == "insert").alias("num_inserted_rows"),
                                   F.count_if(a == "update").alias("num_updated_rows"),
                                   F.count_if(a == "delete").alias("num_deleted_rows"))
                  .filter(a != "delete").drop("_action"))
        B.write_buckets(spark, B.with_bucket(out, keys, n_buckets), path, change_id, read)
        return dict(obs.get)
    finally:
        s.unpersist()


def incremental_since(source: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows of ``source`` past the target's high-water mark on ``col``.

    The mark is one scalar; it is folded in as a literal so the scan prunes by it.
    """
    hwm = target.agg(F.max(col).alias("m")).collect()[0]["m"]
    if hwm is None:
        return source
    return source.filter(F.col(col) > F.lit(hwm))


# ---------------------------------------------------------------- snapshot SCD2

def scd2_compare(target: DataFrame, snapshot: DataFrame, keys, tracked: list[str], as_of,
                 valid_from: str = "valid_from", valid_to: str = "valid_to",
                 is_current: str = "is_current", version: str = "scd_version",
                 close_missing: bool = False, change_when=None) -> DataFrame:
    """Snapshot-driven SCD2 in one pass.

    Current rows whose tracked columns differ (NULL-safe) from the snapshot
    are closed (``valid_to`` = as_of, not current) and a new version
    (version + 1) opens; new keys open version 1; unchanged rows stay.
    ``change_when`` (a predicate on the snapshot, e.g. a correction reason
    being present) restricts which differences open a new version.
    """
    keys = names(keys)
    ts = F.lit(as_of).cast(target.schema[valid_from].dataType) if not isinstance(as_of, Column) else as_of
    history = target.filter(~F.col(is_current))
    cur = target.filter(F.col(is_current)).withColumn("__in_t", F.lit(True))
    snap = snapshot.withColumn("__in_s", F.lit(True))
    j = cur.alias("t").join(snap.alias("s"), on=keys, how="full_outer")
    in_s, in_t = F.col("s.__in_s").isNotNull(), F.col("t.__in_t").isNotNull()
    changed = in_s & in_t & _differs(tracked, "t", "s")
    if change_when is not None:
        cw = _pred(change_when)
        changed = changed & F.coalesce(cw, F.lit(False))
    payload = [c for c in target.columns if c not in keys and c not in (valid_from, valid_to, is_current, version)]
    vt = target.schema[valid_to].dataType

    def row(src: str, vf, vto, cur_flag, ver):
        fields = [F.col(k).alias(k) for k in keys]
        for c in payload:
            if src == "s" and c in snapshot.columns:
                fields.append(F.col(f"s.{c}").alias(c))
            else:
                fields.append(F.col(f"t.{c}").alias(c))
        fields += [vf.alias(valid_from), vto.cast(vt).alias(valid_to), cur_flag.alias(is_current),
                   ver.cast(target.schema[version].dataType).alias(version)]
        return F.struct(*fields)

    keep_t = row("t", F.col(f"t.{valid_from}"), F.col(f"t.{valid_to}"), F.col(f"t.{is_current}"), F.col(f"t.{version}"))
    closed = row("t", F.col(f"t.{valid_from}"), ts, F.lit(False), F.col(f"t.{version}"))
    opened = row("s", ts, F.lit(None), F.lit(True), F.col(f"t.{version}") + 1)
    new1 = row("s", ts, F.lit(None), F.lit(True), F.lit(1))
    rows = (F.when(in_s & ~in_t, F.array(new1))
             .when(changed, F.array(closed, opened))
             .when(in_t & ~in_s & F.lit(close_missing), F.array(closed))
             .otherwise(F.array(keep_t)))
    out = j.select(F.explode(rows).alias("r")).select("r.*")
    return history.unionByName(out)


def scd2_snapshot_into(spark, path: str, snapshot: DataFrame, keys, tracked: list[str], as_of, n_buckets: int,
                       change_id, close_missing: bool = False, **kw) -> None:
    """Snapshot SCD2 on a key-bucketed table: only buckets holding snapshot keys are
    read and rewritten (all buckets when ``close_missing``, which must see every key)."""
    from strata.operators import buckets as B
    keys = names(keys)
    snapshot = B.with_stored_keys(spark, path, snapshot, keys, n_buckets)
    s = B.with_bucket(snapshot, keys, n_buckets).persist()
    try:
        ids = None if close_missing else B.touched_buckets(s)
        t = B.read_buckets(spark, path, ids)
        if t is None:
            raise ValueError(f"no SCD2 table at {path}; create it with buckets.create_bucketed")
        out = scd2_compare(t.drop(B.BUCKET), s.drop(B.BUCKET), keys, tracked, as_of, close_missing=close_missing, **kw)
        B.write_buckets(spark, B.with_bucket(out, keys, n_buckets), path, change_id)
    finally:
        s.unpersist()


def apply_corrections(target: DataFrame, corrections: DataFrame, keys, tracked: list[str], as_of,
                      reason_col: str = "correction_reason", **kw) -> DataFrame:
    """Audit trail: a correction (reason present) closes the current version and opens
    the next; rows without a reason for unknown keys open version 1."""
    snap = corrections
    return scd2_compare(target, snap.drop(reason_col), keys, tracked, as_of, **kw) if reason_col not in snap.columns else \
        _corrections(target, snap, keys, tracked, as_of, reason_col, **kw)


def _corrections(target, snap, keys, tracked, as_of, reason_col, **kw):
    keys = names(keys)
    has_reason = snap.filter(F.col(reason_col).isNotNull())
    no_reason = snap.filter(F.col(reason_col).isNull())
    # Rows without a reason only insert new keys; for existing keys they change nothing.
    new_keys = no_reason.join(target.select(*keys).distinct(), on=keys, how="left_anti")
    src = has_reason.unionByName(new_keys).drop(reason_col)
    return scd2_compare(target, src, keys, tracked, as_of, **kw)


def update_where(df: DataFrame, predicate, assignments: dict) -> DataFrame:
    """UPDATE t SET c = expr WHERE predicate, as a projection (rows keep their place)."""
    p = F.coalesce(_pred(predicate), F.lit(False))
    out = df
    for c, v in assignments.items():
        val = F.expr(v) if isinstance(v, str) else (v if isinstance(v, Column) else F.lit(v))
        out = out.withColumn(c, F.when(p, val.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out


def delete_where(df: DataFrame, predicate) -> DataFrame:
    """DELETE FROM t WHERE predicate (rows where it is NULL stay, as in SQL)."""
    return df.filter(~F.coalesce(_pred(predicate), F.lit(False)))


def point_in_time(facts: DataFrame, history: DataFrame, keys, fact_ts: str,
                  start_col: str = START, end_col: str = END, how: str = "left",
                  chunk_width: str = "auto", prefix: str = "", checkpoint: bool = True) -> DataFrame:
    """Join each fact to the version of its key valid at ``fact_ts``.

    Valid means ``start <= ts AND (end IS NULL OR ts < end)``. Instead of an
    equi-join on the key followed by the interval filter (all versions x all
    facts of a key), facts and version starts are merged in time order and
    each fact takes the latest start at or before it (skew-safe, see
    ``last_before_in_key``).
    """
    keys = names(keys)
    payload_cols = [c for c in history.columns if c not in keys]
    h = history.select(*keys, F.col(start_col).alias("__ts"),
                       F.struct(*[F.col(c) for c in payload_cols]).alias("__ver"),
                       F.lit(True).alias("__m"))
    f = facts.withColumn("__ts", F.col(fact_ts)).withColumn("__fact", F.struct(*[F.col(c) for c in facts.columns]))
    f = f.select(*keys, "__ts", "__fact", F.lit(True).alias("__fm"), F.lit(False).alias("__m"))
    h = h.withColumn("__fact", F.lit(None).cast(f.schema["__fact"].dataType)).withColumn("__fm", F.lit(None).cast("boolean"))
    f = f.withColumn("__ver", F.lit(None).cast(h.schema["__ver"].dataType))
    both = f.unionByName(h)
    if checkpoint:
        both = materialize(both)
    if chunk_width == "auto":
        chunk_width = auto_chunk_width(both, keys, "__ts")
    res = last_before_in_key(both, keys, "__ts", "__m", "__ver", "__match", time_chunk(F.col("__ts"), chunk_width))
    valid = F.col("__match").isNotNull() & (F.col(f"__match.{end_col}").isNull() | (F.col("__ts") < F.col(f"__match.{end_col}")))
    res = res.withColumn("__match", F.when(valid, F.col("__match")))
    if how == "inner":
        res = res.filter(F.col("__match").isNotNull())
    ver_cols = [F.col(f"__match.{c}").alias(prefix + c) for c in payload_cols]
    return res.select("__fact.*", *ver_cols)
