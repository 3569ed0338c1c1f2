"""Conform datasets to the data model and shape event payloads.

P1 field renames, P5 drops, P6 keep-only projections, P7 constants, P8 ISO
instants, P9 optional fields (``to_json`` omits nulls), P10 stringified
values, I4 payloads, I5 routing, I6 batches of 100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockmap.schemas import DATASET_ORDER, spec
from stockmap.session import materialize

# Event routing.
EVENT_TYPES = {
    "inv_level": "scn.data.inventorylevel",
    "inbound_order": "scn.data.inboundorder",
    "inbound_order_line": "scn.data.inboundorderline",
}
GENERIC_EVENT = "scn.data.dataset"
EVENT_DATASETS = (
    "company", "geography", "product_hierarchy", "product", "trading_partner", "site", "inv_policy",
    "inv_level", "inbound_order", "inbound_order_line",
)
# Batch size, the placeholder and the open interval of the data model.
BATCH_SIZE = 100
NO_VALUE = "SCN_RESERVED_NO_VALUE_PROVIDED"
OPEN_START_TS = "1900-01-01T00:00:00Z"
OPEN_END_TS = "9999-12-31T23:59:59Z"


def cdm_rename(df: DataFrame, dataset: str) -> DataFrame:
    """Old field names → data-model names. A name absent from ``df`` is ignored;
    when both old and new exist, the new value wins and the old fills its gaps."""
    out = df
    for old, new in spec(dataset).renames.items():
        if old not in out.columns:
            continue
        if new in out.columns:
            out = out.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
        else:
            out = out.withColumnRenamed(old, new)
    return out


def drop_forbidden(df: DataFrame, dataset: str) -> DataFrame:
    return df.drop(*[c for c in spec(dataset).forbidden if c in df.columns])


def conform(df: DataFrame, dataset: str, constants: dict[str, object] | None = None) -> DataFrame:
    """Rename, drop forbidden fields, add constant columns where missing, order columns as declared."""
    out = drop_forbidden(cdm_rename(df, dataset), dataset)
    for k, v in (constants or {}).items():
        if k not in out.columns:
            out = out.withColumn(k, F.lit(v))
    declared = [c for c in spec(dataset).columns if c in out.columns]
    extra = [c for c in out.columns if c not in declared]
    return out.select(*declared, *extra)


# ---------------------------------------------------------------- payloads

def _has(df: DataFrame, c: str) -> bool:
    return c in df.columns


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def iso_start(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def iso_end(c: Column) -> Column:
    return F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T23:59:59Z"))


def _first_present(df: DataFrame, names: Sequence[str]) -> Column | None:
    present = [F.col(n) for n in names if _has(df, n)]
    if not present:
        return None
    return present[0] if len(present) == 1 else F.coalesce(*present)


def payload_struct(df: DataFrame, dataset: str) -> tuple[DataFrame, Column]:
    """(renamed frame, event record struct); struct field order = JSON key order."""
    d = df.drop("connection_id") if _has(df, "connection_id") else df
    return _payload(d, dataset)


def _payload(d: DataFrame, dataset: str):
    if dataset == "company":
        return d, F.struct(_s("id").alias("id"), _s("description").alias("description"))
    if dataset == "trading_partner":
        d = cdm_rename(d.drop(*[c for c in ("geo_id", "eff_start_date", "eff_end_date") if _has(d, c)]), dataset)
        keep = [c for c in d.columns if c != "tpartner_type"]
        tp = F.coalesce(F.col("tpartner_type"), F.lit("SUPPLIER")) if _has(d, "tpartner_type") else F.lit("SUPPLIER")
        return d, F.struct(*[F.col(c) for c in keep], tp.alias("tpartner_type"), F.lit(NO_VALUE).alias("geo_id"),
                        F.lit(OPEN_START_TS).alias("eff_start_date"), F.lit(OPEN_END_TS).alias("eff_end_date"))
    if dataset == "site":
        d = drop_forbidden(cdm_rename(d, dataset), dataset)
        return d, F.struct(*[(_s(c) if c == "id" else F.col(c)).alias(c) for c in d.columns])
    if dataset == "product":
        d = drop_forbidden(cdm_rename(d, dataset), dataset)
        return d, F.struct(*[F.col(c) for c in d.columns])
    if dataset == "inv_level":
        exp = _first_present(d, ("expiry_date", "expiration_date"))
        fields = [iso_start(F.col("snapshot_date")).alias("snapshot_date"), _s("site_id").alias("site_id"),
                  _s("product_id").alias("product_id"), _s("on_hand_inventory").alias("on_hand_inventory"),
                  _s("inv_condition").alias("inv_condition"), _s("lot_number").alias("lot_number")]
        if exp is not None:
            fields.append(F.when(exp.isNotNull(), iso_start(exp)).alias("expiry_date"))
        return d, F.struct(*fields)
    if dataset == "inbound_order":
        fields = [_s("id").alias("id"), _s("tpartner_id").alias("tpartner_id")]
        for c in ("order_type", "order_status"):
            if _has(d, c):
                fields.append(_s(c).alias(c))
        dest = _first_present(d, ("destination_site_id", "to_site_id"))
        if dest is not None:
            fields.append(dest.cast("string").alias("to_site_id"))
        return d, F.struct(*fields)
    if dataset == "inbound_order_line":
        fields = [_s(c).alias(c) for c in ("id", "order_id", "tpartner_id", "product_id")]
        for c in ("to_site_id", "quantity_submitted", "quantity_uom", "status"):
            if _has(d, c):
                fields.append(_s(c).alias(c))
        if _has(d, "expected_delivery_date"):
            fields.append(iso_start(F.col("expected_delivery_date")).alias("expected_delivery_date"))
        return d, F.struct(*fields)
    if dataset == "inv_policy":
        conv = {"site_id": _s("site_id"), "product_id": _s("product_id"),
                "eff_start_date": iso_start(F.col("eff_start_date")), "eff_end_date": iso_end(F.col("eff_end_date"))}
        return d, F.struct(*[conv.get(c, F.col(c)).alias(c) for c in d.columns])
    if dataset in ("geography", "product_hierarchy"):
        return d, F.struct(*[F.col(c) for c in d.columns])
    raise ValueError(f"{dataset} is not sent as events")


def event_payload(df: DataFrame, dataset: str, key: str | None = None) -> DataFrame:
    """(dataset, record_key, payload): one JSON record per row, nulls omitted."""
    k = key or spec(dataset).key[0]
    d, rec = payload_struct(df, dataset)
    return d.select(F.lit(dataset).alias("dataset"), F.col(k).cast("string").alias("record_key"),
                    F.to_json(rec).alias("payload"))


# ---------------------------------------------------------------- routing (I5) and batches

def routing_table(spark) -> DataFrame:
    """15 rows: dataset, event_type, operation, eligible (a fixed dimension: broadcast-safe)."""
    rows = []
    for d in DATASET_ORDER:
        if d in EVENT_TYPES:
            rows.append((d, EVENT_TYPES[d], None, True))
        elif d in EVENT_DATASETS:
            rows.append((d, GENERIC_EVENT, "UPSERT", True))
        else:
            rows.append((d, None, None, False))
    return spark.createDataFrame(rows, "dataset string, event_type string, operation string, eligible boolean")


def route_events(records: DataFrame) -> DataFrame:
    """Attach event_type / operation / eligible to rows with a ``dataset`` column."""
    r = routing_table(records.sparkSession)
    return records.join(F.broadcast(r), "dataset", "left").withColumn("eligible", F.coalesce("eligible", F.lit(False)))


def split_routed(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): rows of event-eligible datasets, and the rest (a reject output)."""
    r = route_events(records)
    return r.where("eligible"), r.where(~F.col("eligible")).drop("event_type", "operation")


def event_batches(payloads: DataFrame, group_ts: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Batches of ``batch_size`` records per dataset, in record order.

    Records of datasets that are not sent go first. Numbering is global
    (range-sorted, no single-task window) and restarts per dataset. Sorted
    rows are read back in order, so each task joins the rows of a batch as
    they come; only batches that lie across two tasks, and the last of each
    dataset, go through a shuffle, as pieces of at most ``batch_size`` records.
    """
    n = numbered_records(payloads, ["record_key", "payload"])
    return as_events(joined_pieces(batch_pieces(n, batch_size), batch_size), group_ts)


def numbered_records(payloads: DataFrame, order: list[str], reread: bool = False) -> DataFrame:
    """(dataset, payload, rn) of the records that are sent, numbered per dataset in ``order`` (``reread``: see ``row_number_global``)."""
    from stockmap.plans.numbering import row_number_global
    sent = split_routed(payloads)[0].select("dataset", "payload", *[c for c in order if c != "payload"])
    n = row_number_global(sent, order, "_rn", within="dataset", reread=reread)
    return n.select("dataset", "payload", F.col("_rn").cast("long").alias("rn"))


def batch_pieces(numbered: DataFrame, batch_size: int) -> DataFrame:
    """Runs of consecutive records of one batch, as the tasks read them: dataset, batch_no, first, records, data."""
    return materialize(numbered.select("dataset", "rn", "payload").mapInArrow(_pieces(batch_size), PIECE_SCHEMA), "event-pieces")


def joined_pieces(pieces: DataFrame, batch_size: int) -> DataFrame:
    """One row for each batch; only pieces shorter than a batch are shuffled."""
    return pieces.where(F.col("records") == batch_size).unionByName(torn_batches(pieces, batch_size))


def torn_batches(pieces: DataFrame, batch_size: int) -> DataFrame:
    """The batches that lie in several pieces or are not full: two for each task and dataset at most."""
    torn = pieces.where(F.col("records") != batch_size).groupBy("dataset", "batch_no").agg(
        F.min("first").alias("first"), F.sum("records").alias("records"), F.array_sort(F.collect_list(F.struct("first", "data"))).alias("_p"))
    return torn.withColumn("data", F.array_join(F.transform("_p", lambda x: x["data"]), ",")).drop("_p")


def as_events(batches: DataFrame, group_ts: str) -> DataFrame:
    """Batches with their group id, event type and operation, the records as one JSON array."""
    return route_events(batches).select(
        "dataset", "batch_no", F.concat(F.col("dataset"), F.lit(f"-{group_ts}")).alias("event_group_id"),
        "event_type", "operation", "records", F.concat(F.lit("["), "data", F.lit("]")).alias("data"))


PIECE_SCHEMA = "dataset string, batch_no int, first long, records long, data string"


def _pieces(batch_size: int):
    """Arrow batches of numbered rows to one row for each run of rows of the same event batch."""
    def run(batches):
        import pyarrow as pa

        names = ["dataset", "batch_no", "first", "records", "data"]
        key, first, held, last = None, 0, [], 0

        def piece():
            return (key[0], key[1], first, len(held), ",".join(held))

        for batch in batches:
            out = []
            for ds, rn, payload in zip(*(batch.column(c).to_pylist() for c in ("dataset", "rn", "payload")), strict=True):
                k = (ds, (rn - 1) // batch_size + 1)
                if k != key or rn != last + 1:
                    if held:
                        out.append(piece())
                    key, first, held = k, rn, []
                held.append(payload)
                last = rn
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECE_TYPES(pa), strict=True)], names=names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(piece(), _PIECE_TYPES(pa), strict=True)], names=names)
    return run


def _PIECE_TYPES(pa):
    return pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()
