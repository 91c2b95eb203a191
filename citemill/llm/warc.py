"""Not-modified revisits of WARC files, joined to the response they confirm.

A revisit belongs to the latest earlier full response of its canonical address. The as-of
join sorts addresses and times over the whole table by range, carries the last response
along inside each task, and hands it on across tasks through one row a task, so captures of
one address may be a third of all records. Only ids, addresses and times are sorted;
headers are joined afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from citemill.llm.common import stored

# What a 304 response may not change in the stored one (RFC 9111, 3.1 and 3.2).
NOT_MERGED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "te", "trailer",
    "transfer-encoding", "upgrade",
)
# Parameters of addresses that do not choose the content.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid|jsessionid|phpsessid|sid)$"
_ADDRESS = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.``, default port, user, fragment and tracking parameters.

    The scheme is dropped, parameters are sorted, slashes at the end go. What is no address
    stays as it is, trimmed; null stays null.
    """
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _ADDRESS, 1)), r"^www\d*\.", "")
    port = F.regexp_extract(url, _ADDRESS, 2)
    path = F.regexp_replace(F.regexp_extract(url, _ADDRESS, 3), r"/+$", "")
    named = F.filter(
        F.split(F.regexp_extract(url, _ADDRESS, 4), "&"),
        lambda p: (p != "") & ~F.lower(F.regexp_extract(p, "^([^=]*)", 1)).rlike(TRACKING),
    )
    query = F.array_join(F.array_sort(named), "&")
    made = F.concat(
        host,
        F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)),
        F.when(path == "", "/").otherwise(path),
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
    )
    return F.when(host == "", F.trim(url)).otherwise(made)


def header_map(lines: Column) -> Column:
    """Header lines as a map from names in lower case; values of repeated names are joined."""
    pairs = F.transform(
        F.filter(F.split(F.coalesce(lines, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^:\s]+:")),
        lambda x: F.struct(
            F.lower(F.regexp_extract(x, r"^([^:]+):", 1)).alias("name"),
            F.trim(F.regexp_extract(x, r"^[^:]+:(.*)$", 1)).alias("value"),
        ),
    )

    def joined(pairs: Column) -> Column:
        names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["name"])))
        return F.map_from_entries(
            F.transform(
                names,
                lambda n: F.struct(
                    n,
                    F.array_join(
                        F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", "
                    ),
                ),
            )
        )

    return F.transform(F.array(pairs), joined)[0]


def parse_records(rows: DataFrame, record: str = "record") -> DataFrame:
    """``rows`` with the parts of a WARC record: ``warc``, ``status``, ``headers``, ``body``.

    ``warc`` and ``headers`` are maps, ``status`` is the HTTP status or null. What is missing in
    a cut or empty record is empty or null. The record's own column is dropped.
    """
    parts = F.split(F.coalesce(F.col(record), F.lit("")), r"\r?\n\r?\n", 3)
    http = F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    return rows.select(
        *[F.col(c) for c in rows.columns if c not in (record, "warc", "status", "headers", "body")],
        header_map(F.get(parts, F.lit(0))).alias("warc"),
        F.regexp_extract(http, r"^HTTP/\S+ (\d{3})", 1).try_cast("int").alias("status"),
        header_map(http).alias("headers"),
        F.get(parts, F.lit(2)).alias("body"),
    )


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows in the order of key and time: the last full one before, and up to, each."""
    part, key, last, nth = TaskContext.get().partitionId(), None, None, 0
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        full = batch.column("full").to_numpy(zero_copy_only=False).astype(bool)
        new = np.ones(rows, bool)
        new[1:] = keys[1:] != keys[:-1]
        new[0] = keys[0] != key
        first = np.maximum.accumulate(np.where(new, np.arange(rows), -1))
        at = np.maximum.accumulate(np.where(full, np.arange(rows), -1))
        inside = (at >= 0) & (at >= first)  # a full row of the same key in this batch
        upto = np.where(inside, ids[np.maximum(at, 0)], 0)
        known = inside.copy()
        if last is not None:
            upto[(first < 0) & ~inside] = last
            known[(first < 0) & ~inside] = True
        before = np.concatenate(([0 if last is None else last], upto[:-1]))
        earlier = np.concatenate(([last is not None], known[:-1])) & ~new
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(before, pa.int64(), mask=~earlier),
                pa.array(upto, pa.int64(), mask=~known),
                pa.array(np.full(rows, part, np.int32)),
                pa.array(np.arange(nth, nth + rows)),
            ],
            names=[*batch.schema.names, "before", "upto", "part", "nth"],
        )
        key, last, nth = keys[-1], int(upto[-1]) if known[-1] else None, nth + rows


def latest_before(rows: DataFrame) -> DataFrame:
    """``id`` and ``match`` for rows that are not ``full``: the latest full one earlier.

    ``rows`` has ``key``, ``time``, ``id`` (long, unique) and ``full``. Rows at the same time are not
    earlier; of full rows at one time the largest id counts. Rows without key, time or id
    are left out. The driver sees one row a task.
    """
    spark = rows.sparkSession
    usable = rows.select("key", "time", "id", "full").dropna()
    usable = stored(usable, "captures")
    order = ["key", "time", "full", "id"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in usable.schema)
    placed = usable.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _carried, f"{kinds}, before long, upto long, part int, nth long"
    )
    placed = stored(placed, "captures-in-order")
    ends = placed.groupBy("part").agg(
        F.min(F.struct("nth", "key")).alias("head"), F.max(F.struct("nth", "key", "upto")).alias("tail")
    )
    handed, key, last = [], None, None
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        head, tail = row["head"], row["tail"]
        if last is not None and head["key"] == key:
            handed.append((row["part"], key, last))
        if tail["upto"] is not None or tail["key"] != key:
            last = tail["upto"]
        key = tail["key"]
    carried = spark.createDataFrame(handed, "part int, key_ string, carried long")
    # One row a task at most.
    joined = placed.filter(~F.col("full")).join(F.broadcast(carried), "part", "left")
    from_others = F.when(F.col("key") == F.col("key_"), F.col("carried"))
    return joined.select("id", F.coalesce("before", from_others).alias("match"))


def _opaque(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, carry: tuple[str, ...] = ("body",)) -> DataFrame:
    """One row per given record: what it stands for after its revisit is resolved.

    ``records`` has ``record_id`` (long, unique), ``url``, ``captured`` (timestamp), ``status`` and
    ``headers`` (see ``parse_records``), and may have ``kind`` (the record's type, in any case) and
    ``payload_digest``. Full responses are records of type ``response`` with status 200. Revisits are
    those of type ``revisit``, whatever their status, and responses with status 304. Without ``kind``, or
    where it is null, the status decides alone; others pass as they are. Results: ``record_id``, ``canonical_url``, ``refers_to``, ``outcome``,
    ``headers`` and the columns in ``carry``, which a resolved revisit takes from its response.

    A revisit with a payload digest, other than a 304, must have that of the response if that has
    one. Apart from that, a revisit's entity tag must equal the response's, weakness apart; without one its date of last
    change must; without either the response may have neither. Outcomes: ``full``, ``other``,
    ``resolved``, ``no_earlier_response`` (also where address or time is null),
    ``validator_mismatch``. Unresolved revisits keep their own headers and columns. Merged headers
    are the response's, replaced or extended by the revisit's but for ``NOT_MERGED``. Times that
    are equal are not earlier. A null id is resolved to nothing; an empty table gives an empty one.
    """
    given = {c.lower() for c in records.columns}
    text = lambda name: (F.col(name) if name in given else F.lit(None)).cast("string")
    records = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "captured", "status", "headers",
        F.lower(text("kind")).alias("_kind"), text("payload_digest").alias("_digest"), *carry
    )
    response_like = F.coalesce(F.col("_kind") == "response", F.lit(True))
    full = response_like & (F.col("status") == 200)
    again = F.coalesce(F.col("_kind") == "revisit", F.lit(False)) | (response_like & (F.col("status") == 304))
    narrow = records.filter(full | again).select(
        F.col("canonical_url").alias("key"), F.col("captured").alias("time"),
        F.col("record_id").alias("id"), full.alias("full"),
    )
    matches = latest_before(narrow).filter(F.col("match").isNotNull())
    found = records.join(matches, F.col("record_id") == F.col("id"), "left").drop("id")
    response = records.filter(full).select(
        F.col("record_id").alias("match_"), F.col("headers").alias("old"), F.col("_digest").alias("_old_digest"), *[F.col(c).alias(f"old_{c}") for c in carry]
    )
    found = found.join(response, F.col("match") == F.col("match_"), "left")
    tag, old_tag = F.col("headers")["etag"], F.col("old")["etag"]
    changed, old_changed = F.col("headers")["last-modified"], F.col("old")["last-modified"]
    not_modified = F.coalesce(F.col("status") == 304, F.lit(False))
    digests = ~not_modified & F.col("_digest").isNotNull() & F.col("_old_digest").isNotNull()
    valid = (
        F.when(digests, F.col("_digest") == F.col("_old_digest"))
        .when(tag.isNotNull(), _opaque(tag).eqNullSafe(_opaque(old_tag)))
        .when(changed.isNotNull(), changed.eqNullSafe(old_changed))
        .otherwise(old_tag.isNull() & old_changed.isNull())
    )
    outcome = (
        F.when(full, "full")
        .when(~F.coalesce(again, F.lit(False)), "other")
        .when(F.col("match").isNull(), "no_earlier_response")
        .when(valid, "resolved")
        .otherwise("validator_mismatch")
    )
    found = found.withColumn("outcome", outcome)
    permitted = F.map_filter("headers", lambda name, _: ~name.isin(*NOT_MERGED))
    merged = F.map_concat(
        F.map_filter("old", lambda name, _: ~F.map_contains_key(permitted, name)), permitted
    )
    resolved = F.col("outcome") == "resolved"
    return found.select(
        "record_id", "canonical_url", F.when(resolved, F.col("match")).alias("refers_to"), "outcome",
        F.when(resolved, merged).otherwise(F.col("headers")).alias("headers"),
        *[F.when(resolved, F.col(f"old_{c}")).otherwise(F.col(c)).alias(c) for c in carry],
    )
