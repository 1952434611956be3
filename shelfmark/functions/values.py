"""Casts, hashes, keys, places and addresses as Spark column expressions."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, functions as F

from shelfmark.functions.text import blank_to_null, normalize_string, trim_ws

# Words that stand for truth, and the columns of the content fingerprint in their order.
TRUE_WORDS, FALSE_WORDS = ["1", "true", "yes", "y", "on"], ["0", "false", "no", "n", "off"]
FINGERPRINT = ["available_count", "discount_price", "loyal_price", "parser_name", "price", "price_unit", "source_id"]


def safe_double(c: Column) -> Column:
    """A number, decimal comma allowed; anything else is null."""
    s = F.regexp_replace(trim_ws(c.cast("string")), ",", ".")
    return F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s.try_cast("double"))


def safe_long(c: Column) -> Column:
    """A whole number; fractions are null."""
    d = safe_double(c)
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def safe_bool(c: Column) -> Column:
    s, d = F.lower(trim_ws(c.cast("string"))), safe_double(c)
    return F.when(s.isin(TRUE_WORDS), True).when(s.isin(FALSE_WORDS), False).when(d.isNotNull(), d != 0)


def parse_instant(c: Column) -> Column:
    """ISO text to a timestamp; without an offset it is UTC; unreadable is null."""
    return F.try_to_timestamp(F.regexp_replace(trim_ws(c), "Z$", "+00:00"))


def iso(c: Column) -> Column:
    """Timestamp as ISO text with offset; microseconds only where there are any."""
    whole = F.unix_micros(c) % 1_000_000 == 0
    return F.when(whole, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def string_list(c: Column) -> Column:
    """A JSON array, comma-separated text or a single value as an array without blanks."""
    s = trim_ws(c)
    parsed = F.when(s.startswith("["), F.coalesce(F.from_json(s, "array<string>"), F.array(s))).otherwise(F.split(s, ","))
    return F.filter(F.transform(F.coalesce(parsed, F.array().cast("array<string>")), blank_to_null), lambda x: x.isNotNull())


def sha(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def content_fingerprint(columns: dict[str, Column] | None = None) -> Column:
    """sha256 of the JSON of FINGERPRINT's columns, nulls kept. Doubles are below 1e7, where JSON writes them plainly."""
    columns = columns or {}
    return sha(F.to_json(F.struct(*[columns.get(n, F.col(n)).alias(n) for n in FINGERPRINT]), {"ignoreNullFields": "false"}))


def event_uid(parser: Column, source: Column, at: Column, product: Column, artifact: Column) -> Column:
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return sha(F.concat_ws("|", part(parser), part(source), iso(at), part(product), part(artifact)))


def as_uuid(c: Column) -> Column:
    """A hash written as a UUID: stable when a task runs again."""
    h = F.sha2(c.cast("string"), 256)
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))


def category_key(parser: Column, uid: Column, title: Column) -> Column:
    u = blank_to_null(uid)
    return F.when(u.isNotNull(), F.concat(parser, F.lit(":uid:"), F.lower(u))).otherwise(F.concat(parser, F.lit(":title:"), sha(title).substr(1, 40)))


def geo_key(country: Column, region: Column, name: Column) -> Column:
    """country|region|name without outer bars; null if all are."""
    parts = [F.coalesce(normalize_string(c), F.lit("")) for c in (country, region, name)]
    return F.nullif(F.regexp_replace(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2]), r"^\|+|\|+$", ""), F.lit(""))


def geo_fingerprint(key: Column, lat: Column, lon: Column) -> Column:
    return sha(F.format_string("%s:%.8f:%.8f", key, lat, lon))


def backoff_seconds(attempts: Column) -> Column:
    return F.least(F.lit(300), F.pow(F.lit(2), F.least(F.greatest(F.lit(0), attempts - 1), F.lit(30)))).cast("int")


def natural_id(source: Column, sku: Column, plu: Column, canonical: Column, at: Column) -> Column:
    s, k, p = (blank_to_null(c) for c in (source, sku, plu))
    return F.coalesce(s, F.concat(F.lit("sku:"), k), F.concat(F.lit("plu:"), p), F.concat(F.lit("generated:"), F.coalesce(canonical, F.lit("unknown")), F.lit(":"), iso(at)))


def image_name(url: Column, base: str) -> Column:
    """File name of an image of the storage at base; null for other hosts and for names with path parts."""
    where = urlsplit(base)
    same = (F.try_parse_url(url, F.lit("PROTOCOL")) == where.scheme) & (F.try_parse_url(url, F.lit("HOST")) == (where.hostname or ""))
    path = F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), r"^/?(api/)?images/", "")
    name = F.try_url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.when(same & (name != "") & ~name.rlike(r"[/\\]|\.\."), name)


def is_mysql_dsn(value: str) -> bool:
    return value.strip().lower().startswith(("mysql://", "mysql+pymysql://"))


def parse_dsn(value: str) -> dict:
    """Host, port, user, password, database and charset of a MySQL address; the database must be there."""
    if not is_mysql_dsn(value):
        raise ValueError("not a MySQL address")
    at = urlsplit(value.strip())
    name = at.path.strip("/")
    if not name:
        raise ValueError("the address names no database")
    charset = dict(p.split("=", 1) for p in at.query.split("&") if "=" in p).get("charset", "utf8mb4")
    return {"host": at.hostname or "127.0.0.1", "port": at.port or 3306, "user": unquote(at.username or ""), "password": unquote(at.password or ""), "database": name, "charset": charset}


def safe_reference(value: str) -> str:
    """An address or path for logs, without user and password."""
    if not is_mysql_dsn(value):
        return value
    at = parse_dsn(value)
    return f"mysql://{at['host']}:{at['port']}/{at['database']}"


def json_safe(c: Column) -> Column:
    """Any value as JSON text: structs, maps, arrays and what they hold at any depth; instants as ISO-8601 in UTC with microseconds,
    nulls of structs kept."""
    return F.to_json(c, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"})


def payload(c: Column) -> Column:
    """A payload of any shape as VARIANT: a text that is JSON by its content, another value through json_safe(); null if neither."""
    return F.try_parse_json(c)


def payload_value(c: Column, path: str, kind: str) -> Column:
    """The value at a path ($.a.b[0]) of a VARIANT as a Spark type; null if it isn't there or of another kind."""
    return F.try_variant_get(c, path, kind)
