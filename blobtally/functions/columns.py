"""Scalar column functions used by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_utf8(c: ColumnOrName) -> Column:
    """Bytes -> UTF-8 string; malformed sequences become U+FFFD instead of failing the job.

    (``decode(b, 'UTF-8')`` raises on malformed input in Spark 4; a single bad object key must
    not stop a run over the whole table, and a JVM byte-to-string conversion also replaces.)
    """
    return F.make_valid_utf8(_col(c).cast("string"))


def bytes_to_long(c: ColumnOrName) -> Column:
    """Big-endian signed 64-bit value of the first 8 bytes -> BIGINT.

    Null and empty inputs give null (they are filtered out before decoding anyway). Longer
    arrays are read from their first 8 bytes and shorter ones fail the query, as in the
    original decoder (a truncated size cell is corrupt data, not something to skip silently).
    """
    b = _col(c)
    # conv to base -10 reads the hex digits as an unsigned 64-bit value and prints it signed.
    value = F.conv(F.hex(F.substring(b, 1, 8)), 16, -10).cast("bigint")
    return (
        F.when(b.isNull() | (F.length(b) == 0), F.lit(None).cast("bigint"))
        .when(F.length(b) >= 8, value)
        .otherwise(F.raise_error(F.lit("size cell is shorter than an 8-byte long")).cast("bigint"))
    )


def is_archived(object_key: ColumnOrName, archive_bucket: str) -> Column:
    """Object lives in the archive bucket: key starts with '<bucket>/' (slash included)."""
    if not archive_bucket:
        raise ValueError("archive_bucket must be a non-empty bucket name")
    return _col(object_key).startswith(archive_bucket + "/")


def meta_row_key(file_id: ColumnOrName, blob_id: ColumnOrName, delimiter: str) -> Column:
    """Row key of a meta row: file id, delimiter, blob id."""
    return F.concat(_col(file_id).cast("string"), F.lit(delimiter), _col(blob_id))


INT_MIN, INT_MAX = -(1 << 31), (1 << 31) - 1


def empty_percent(length: ColumnOrName, remain: ColumnOrName) -> Column:
    """Integer percent of a file that is no longer referenced, truncated toward zero.

    A zero-length file gives -1. Negative results (more referenced than stored) are kept. The
    arithmetic is exact (DECIMAL(38,0), so ``(length - remain) * 100`` cannot overflow), and a
    percent outside the INT range fails the run instead of wrapping.
    """
    n = _col(length).cast("decimal(38,0)")
    x = (n - _col(remain).cast("decimal(38,0)")) * F.lit(100)
    # SQL `div` truncates toward zero like the JVM's long division; CASE evaluates only the
    # chosen branch, so the guards come first.
    return (F.when(n == 0, F.lit(-1))
            .when((x <= n * F.lit(INT_MIN - 1)) | (x >= n * F.lit(INT_MAX + 1)),
                  F.raise_error(F.concat(F.lit("empty percent out of range for length "), n.cast("string"))).cast("decimal(38,0)"))
            .otherwise(F.call_function("div", x, n))
            .cast("int"))


def run_day(ts: ColumnOrName) -> Column:
    """Run day folder name, yyyy-MM-dd (wall clock of a TIMESTAMP_NTZ; session zone otherwise)."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def ntz_epoch_millis(ts: ColumnOrName) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC, independent of the session zone."""
    t = _col(ts)
    day_ms = F.unix_date(t.cast("date")).cast("bigint") * F.lit(86_400_000)
    in_day = ((F.hour(t) * 3600 + F.minute(t) * 60).cast("bigint") * 1000
              + (F.extract(F.lit("SECOND"), t) * 1000).cast("bigint"))
    return day_ms + in_day


def _run_dir(base: str, day: ColumnOrName, millis: ColumnOrName) -> Column:
    if not base:
        raise ValueError("base path must be given")
    if not base.endswith("/"):
        raise ValueError("base path must end with '/'")
    return F.concat(F.lit(base + "aggregator/"), _col(day), F.lit("/"), _col(millis).cast("string"))


def run_file_status_path(base: str, day: ColumnOrName, millis: ColumnOrName) -> Column:
    """<base>aggregator/<yyyy-MM-dd>/<epoch millis>/file_status."""
    return F.concat(_run_dir(base, day, millis), F.lit("/file_status"))


def run_file_meta_path(base: str, day: ColumnOrName, millis: ColumnOrName) -> Column:
    """<base>aggregator/<yyyy-MM-dd>/<epoch millis>/file_meta."""
    return F.concat(_run_dir(base, day, millis), F.lit("/file_meta"))


def run_timestamp(path: ColumnOrName) -> Column:
    """Run timestamp of an output path: its second-to-last '/' component as a long, else null.

    Trailing slashes are ignored, as a JVM string split drops trailing empty parts.
    """
    parts = F.split(F.regexp_replace(_col(path), "/+$", ""), "/")
    return F.try_element_at(parts, F.lit(-2)).try_cast("bigint")


def millis_instant(millis: ColumnOrName) -> Column:
    """The instant (TIMESTAMP) of an epoch in milliseconds, such as a run timestamp; null stays null."""
    return F.timestamp_millis(_col(millis))


def cell_label(row_key: ColumnOrName, family: ColumnOrName, qualifier: ColumnOrName) -> Column:
    """Readable name of a cell: ``row:family:qualifier``, each part decoded as UTF-8; null if one is null."""
    return F.concat(decode_utf8(row_key), F.lit(":"), decode_utf8(family), F.lit(":"), decode_utf8(qualifier))


def region_bucket(row_key: ColumnOrName, start_keys: Sequence[bytes]) -> Column:
    """Index of the greatest region start key <= row_key, floor 0 (byte-wise unsigned order).

    Compiled into a balanced tree of comparisons, so each row costs log2(#keys) byte compares
    and the whole expression stays in generated code. ``start_keys`` must be sorted. A null key
    has no region.
    """
    keys = [bytes(k) for k in start_keys]
    if any(keys[i] > keys[i + 1] for i in range(len(keys) - 1)):
        raise ValueError("start keys must be sorted")
    k = _col(row_key)
    if not keys:
        return F.when(k.isNotNull(), F.lit(0))

    # Bucket = (number of keys <= row_key) - 1, floored at 0.
    def tree(lo: int, hi: int) -> Column:
        # Answer for a row whose position among keys[lo:hi] is to be found; keys[lo-1] <= row.
        if lo >= hi:
            return F.lit(max(lo - 1, 0))
        mid = (lo + hi) // 2
        return F.when(k < F.lit(keys[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(k.isNotNull(), tree(0, len(keys)))
