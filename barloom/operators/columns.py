"""Projection, renaming and date cleaning. Names match without regard to case."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.schemas import DATE_FORMAT

#: ISO dates, with or without a time; those with an offset; and a document's extended date.
_TIME = r"[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?"
_ISO = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:{_TIME})?$"
_ZONED = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_TIME} ?(?:Z|[+-][0-9]{{2}}:?[0-9]{{2}})$"
_DOCUMENT_DATE = r'"\$date"\s*:\s*(?:\{\s*"\$numberLong"\s*:\s*)?"?([^"}]+)"?'


def resolve(df: DataFrame, name: str) -> str:
    """The frame's own spelling of a column name."""
    if name in df.columns:
        return name
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"column {name!r} matches {found} in {df.columns}")
    return found[0]


def column(df: DataFrame, name: str):
    return df["`" + resolve(df, name).replace("`", "``") + "`"]


def project(df: DataFrame, names) -> DataFrame:
    """Keep the named columns, in that order and spelled as asked."""
    return df.select(*[column(df, n).alias(n) for n in names])


def drop_columns(df: DataFrame, names) -> DataFrame:
    return df.drop(*[resolve(df, n) for n in names])


def rename_columns(df: DataFrame, mapping, strict=True) -> DataFrame:
    """Rename by mapping. Unmapped columns are an error if strict, else keep their name."""
    by_lower = {old.lower(): new for old, new in mapping.items()}
    unmapped = [c for c in df.columns if c.lower() not in by_lower]
    if strict and unmapped:
        raise KeyError(f"no new name for columns {unmapped}")
    return df.select(*[column(df, c).alias(by_lower.get(c.lower(), c)) for c in df.columns])


def conform(df: DataFrame, schema: T.StructType, formats=(), zone="UTC") -> DataFrame:
    """Pick the schema's columns by name and give them its types; bad values become NULL.

    ``formats`` are tried for dates before ISO ones; instants become dates of ``zone``.
    """
    picked = []
    for field in schema.fields:
        if field.dataType == T.DateType():
            typed = landed_date(df, field.name, formats, zone)
        elif isinstance(field.dataType, T.IntegralType):
            typed = as_integer(df, field.name, field.dataType)
        else:
            typed = column(df, field.name).try_cast(field.dataType)
        picked.append(typed.alias(field.name))
    return df.select(*picked)


def as_integer(df: DataFrame, name: str, integral: T.IntegralType):
    """An integer from any column; whole numbers written with a fraction (12.0) count as such."""
    raw = column(df, name)
    if isinstance(df.schema[resolve(df, name)].dataType, T.IntegralType):
        return raw.try_cast(integral)
    number = raw.try_cast("double")
    whole = F.when(number == F.floor(number), number).try_cast(integral)
    if isinstance(df.schema[resolve(df, name)].dataType, T.StringType):
        return F.coalesce(raw.try_cast(integral), whole)
    return whole


def day_of(instant, zone="UTC"):
    """The date of a TIMESTAMP in a zone, whatever the session's time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (F.unix_micros(instant) / F.lit(1_000_000)).cast("decimal(18,6)")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), epoch + F.make_dt_interval(secs=seconds))
    return local.cast("date")


def landed_date(df: DataFrame, name: str, formats=(), zone="UTC"):
    """A DATE from what sources land: dates, timestamps, ISO text with or without a time, documents'
    ``{"$date": ...}``, or text in one of ``formats``. Anything else gives NULL.

    The time part is dropped; text with an offset, and TIMESTAMP, are instants and give the day in
    ``zone``.
    """
    raw = column(df, name)
    kind = df.schema[resolve(df, name)].dataType
    if isinstance(kind, T.StructType):
        return _text_date(F.to_json(raw), formats, zone)
    if isinstance(kind, T.TimestampType):
        return day_of(raw, zone)
    if isinstance(kind, T.StringType):
        return _text_date(raw, formats, zone)
    return raw.cast("date")


def _text_date(raw, formats, zone):
    wrapped = F.regexp_extract(raw, _DOCUMENT_DATE, 1)
    text = F.trim(F.when(wrapped != "", wrapped).otherwise(raw))
    millis = F.when(wrapped.rlike("^-?[0-9]{1,15}$"), F.timestamp_millis(wrapped.try_cast("bigint")))
    instant = F.when(text.rlike(_ZONED), text.try_cast("timestamp"))
    plain = F.when(text.rlike(_ISO), text.try_cast("timestamp_ntz").cast("date"))
    # Plain dates, the usual case, first: the patterns below are tried on other text only.
    usual = F.when(F.length(raw) == 10, F.try_to_date(raw, DATE_FORMAT))
    given = [F.try_to_date(raw, f) for f in formats]
    return F.coalesce(*given, usual, day_of(millis, zone), day_of(instant, zone), plain)


def as_date(df: DataFrame, name: str, formats=(DATE_FORMAT,)):
    """A DATE from a date, timestamp or text column; text that fits no format gives NULL."""
    raw = column(df, name)
    kind = df.schema[resolve(df, name)].dataType
    if isinstance(kind, T.TimestampType):
        return day_of(raw)
    if not isinstance(kind, T.StringType):
        return raw.cast("date")
    return F.coalesce(*[F.try_to_date(raw, f) for f in formats])


def clean_dates(df: DataFrame, name: str, formats=(DATE_FORMAT,), rejected=None) -> DataFrame:
    """Replace a column by its DATE; ``rejected`` names an optional flag for unreadable text."""
    own = resolve(df, name)
    parsed = as_date(df, own, formats)
    new = {own: parsed}
    if rejected:
        new[rejected] = column(df, own).isNotNull() & parsed.isNull()
    return df.withColumns(new)
