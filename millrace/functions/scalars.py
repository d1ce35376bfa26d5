"""Small scalar functions: ids, tags, HTTP outcomes, waiting times, thresholds, windows of time."""

from __future__ import annotations

import random
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)


def chunk_id(url: Column, index: Column) -> Column:
    return F.concat(F.substring(F.sha2(url, 256), 1, 16), F.lit("_"), index.cast("string"))


def tags_of(raw: Column) -> Column:
    """Tags from JSON that holds strings or objects with a name (empty names dropped); anything else: null."""
    objects = F.from_json(raw, "array<struct<name:string>>")
    named = F.filter(F.transform(objects, lambda x: x["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.when(raw.rlike(r"^\s*\[\s*\{"), named).when(raw.rlike(r"^\s*\["), F.from_json(raw, "array<string>"))


def fetch_outcome(status: Column) -> Column:
    """ok, gone (for good), retry or fail."""
    return F.when(status == 200, "ok").when(status.isin(404, 410), "gone").when(status.isin(403, 429) | (status >= 500) | status.isNull(), "retry").otherwise("fail")


def retry_after_web(value: Column, now: Column) -> Column:
    """Seconds as given, or until an HTTP date (0 if past); null if neither."""
    seconds = F.trim(value).try_cast("double")
    date = F.try_to_timestamp(F.regexp_replace(F.trim(value), r"^[A-Za-z]{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    until = F.greatest(F.lit(0.0), date.cast("double") - now.cast("double"))
    return F.coalesce(seconds, F.when(date.isNotNull(), until))


def retry_after_seconds(value: Column) -> Column:
    """Seconds only, at least 0; null otherwise."""
    seconds = F.trim(value).try_cast("double")
    return F.when(seconds.isNotNull(), F.greatest(F.lit(0.0), seconds))


def retry_after_crawler(value: str, now: datetime | None = None) -> float:
    """Whole seconds or an HTTP date; 0 where there is no wait."""
    try:
        return float(max(0, int(value)))
    except (TypeError, ValueError):
        pass
    try:
        at = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return 0.0
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return max(0.0, (at - (now or datetime.now(UTC))).total_seconds())


def backoff(attempt: int, cap: float, jitter: bool = True, retry_after: float | None = None) -> float:
    """The wait before another attempt; one that was asked for wins."""
    if retry_after is not None:
        return float(retry_after)
    most = min(cap, 2.0**attempt)
    return random.uniform(0, most) if jitter else most


def parse_map(spec: str, cast=int) -> dict:
    """'name:value,name:value'; parts that don't parse are left out."""
    out = {}
    for part in spec.split(","):
        name, colon, value = part.strip().rpartition(":")
        try:
            if colon and name:
                out[name.strip()] = cast(value)
        except ValueError:
            continue
    return out


def url_host(url: Column) -> Column:
    return F.lower(F.parse_url(url, F.lit("HOST")))


def window_start(base: Column, cursor: Column, overlap: str = "5 minutes") -> Column:
    """The later of base and cursor less the overlap; either may be null."""
    return F.greatest(base, cursor - F.expr(f"INTERVAL {overlap}"))


def snippet(text: Column, n: int = 600) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("…"))).otherwise(text)


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def floor_minutes(ts: Column, minutes: int = 5) -> Column:
    return F.window(ts, f"{minutes} minutes")["start"]


def rounded(x: Column, digits: int) -> Column:
    """A double rounded as SQL's round does: x * 10^digits in double, its ties away from zero. F.round takes the decimal form instead."""
    y = x * F.lit(10.0**digits)
    whole = F.rint(y)
    up, down = (y - whole == 0.5) & (y > 0), (y - whole == -0.5) & (y < 0)
    return F.when(up, whole + 1).when(down, whole - 1).otherwise(whole) / F.lit(10.0**digits)


def age_status(finished: Column, as_of: Column, limit: Column) -> tuple[Column, Column]:
    """Age in minutes (one decimal) and ok, stale or unknown."""
    age = (as_of.cast("double") - finished.cast("double")) / 60
    return rounded(age, 1), F.when(age.isNull(), "unknown").when(age <= limit, "ok").otherwise("stale")


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, in double; null where one has no length."""
    to = lambda x: F.transform(x, lambda v: v.cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    x, y = to(a), to(b)
    return F.try_divide(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def general(x: Column, digits: int = 6) -> Column:
    """A number with so many significant digits, no zeros at the end, an exponent below 1e-4 and from 10^digits on.

    What is rounded is the double's exact value, a tie to the even digit; the JVM's formatter rounds its shortest decimal form up.
    """

    @F.arrow_udf("string")
    def written(xs: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.{digits}g}" for v in xs.to_pylist()], pa.string())

    return written(x.cast("double"))


def vector_literal(v: Column, digits: int = 6) -> Column:
    """[a,b,...] for a loader of text, each number as by general(), nulls left out; arrays need none within Spark."""

    @F.arrow_udf("string")
    def written(vs: pa.Array) -> pa.Array:
        flat = vs.flatten()
        if flat.null_count:
            held = [None if x is None else [y for y in x if y is not None] for x in vs.to_pylist()]
            return pa.array([None if x is None else "[" + ",".join(f"{y:.{digits}g}" for y in x) + "]" for x in held], pa.string())
        numbers, out, at = flat.to_numpy().tolist(), [], 0
        for n in vs.value_lengths().to_pylist():
            out.append(None if n is None else "[" + ",".join([f"%.{digits}g"] * n) % tuple(numbers[at : at + n]) + "]")
            at += n or 0
        return pa.array(out, pa.string())

    return written(v.cast("array<double>"))


def text_array_literal(v: Column) -> Column:
    """{"a","b"} with quotes escaped; {} where empty."""
    quoted = F.transform(v, lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))
