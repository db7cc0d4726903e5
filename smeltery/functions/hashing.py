"""The content hash of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smeltery.functions.dates import iso_utc


# Characters that JSON text may show as they are.
_UNSAFE = r"[^\x20!#-\[\]-~]"
_RUNS = r"[\x20-\x7e]+|[^\x20-\x7e]+"


def json_string(col: Column) -> Column:
    """Quoted ASCII-only JSON text: everything outside blank..tilde is written as ``\\uXXXX``.

    Most texts need one pattern test. The others are cut into printable and
    non-printable runs; a non-printable run is written from its UTF-16 units.
    """
    runs = F.regexp_extract_all(col, F.lit(_RUNS), F.lit(0))
    escaped = F.array_join(F.transform(runs, _escape_run), "")
    quote = F.lit('"')
    return F.concat(quote, F.when(col.rlike(_UNSAFE), escaped).otherwise(col), quote)


def _escape_run(run: Column) -> Column:
    units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
    escaped = F.regexp_replace(units, "(.{4})", r"\\u$1")
    for code, short in (("0008", "b"), ("0009", "t"), ("000a", "n"), ("000c", "f"), ("000d", "r")):
        escaped = F.replace(escaped, F.lit(f"\\u{code}"), F.lit(f"\\{short}"))
    printable = F.regexp_replace(run, r'(["\\])', r"\\$1")
    return F.when(run.rlike(r"^[\x20-\x7e]"), printable).otherwise(escaped)


def record_hash(source_id: Column, event_time: Column, category: Column, value: Column) -> Column:
    """SHA-256 of the compact JSON object with sorted keys. The source label is not part of it.

    Without an event time there is no hash and the result is empty. It is never null, which
    spares joins on the hash a null test that would compute it twice.
    """
    digest = F.sha2(
        F.concat(
            F.lit('{"category":'), json_string(category),
            F.lit(',"event_time":"'), iso_utc(event_time),
            F.lit('","source_id":'), json_string(source_id),
            F.lit(',"value":'), json_string(value),
            F.lit("}"),
        ),
        256,
    )
    return F.coalesce(digest, F.lit(""))
