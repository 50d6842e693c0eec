"""Click events to and from their wire formats; each works on batch and streaming frames."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.functions.hours import hour_bucket
from clickmill.schema import ACTIVITY, CLICK_EVENT, EVENT_COLUMNS


def decode_clicks(
    rows: DataFrame, keep: tuple[str, ...] = (), columns: list[str] = ACTIVITY.names
) -> DataFrame:
    """Kafka rows to activity rows: the JSON fields in lower case and the event's hour.

    A payload that does not parse gives NULL fields. `keep` carries envelope columns along;
    `columns` names what is wanted of the activity, and no other field is decoded.
    """
    wanted = {"eventtime" if name == "timestamp_hour" else name for name in columns}
    fields = StructType([f for f in CLICK_EVENT if f.name.lower() in wanted])
    click = F.from_json(F.col("value").cast("string"), fields)
    parsed = rows.select(*keep, click.alias("click"))
    activity = {name.lower(): F.col(f"click.{name}") for name in fields.names}
    if "timestamp_hour" in columns:
        activity["timestamp_hour"] = hour_bucket("click.eventTime")
    return parsed.select(*(activity[name].alias(name) for name in columns), *keep)


def encode_json() -> Column:
    """The event's JSON text, with the field names and order of the wire format."""
    fields = [F.col(name.lower()).alias(name) for name in CLICK_EVENT.names]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


# How a line says NULL, which is not the empty text. Leaving the field out would shift the later ones.
NULL_FIELD = "\\N"


def delimited_line(columns: list[str], delimiter: str = ";") -> Column:
    """The columns as one line of text; delimited_fields reads it back."""
    return F.concat_ws(delimiter, *(F.coalesce(F.col(name).cast("string"), F.lit(NULL_FIELD)) for name in columns))


def encode_tsv() -> Column:
    """The event as one tab-separated line; the text sink adds the line end. NULL is written as NULL_FIELD."""
    return delimited_line(EVENT_COLUMNS, "\t")


def delimited_fields(line, schema: StructType, delimiter: str = ";") -> list[Column]:
    """One typed column per schema field; a missing or unreadable field is NULL, and so is NULL_FIELD."""
    parts = F.split(line, re.escape(delimiter), -1)
    return [
        F.nullif(F.get(parts, F.lit(i)), F.lit(NULL_FIELD)).try_cast(field.dataType).alias(field.name)
        for i, field in enumerate(schema)
    ]


def numbered(prefix: str, number) -> Column:
    """Identifiers such as Visitor-7."""
    return F.concat(F.lit(f"{prefix}-"), F.col(number) if isinstance(number, str) else number)


def previous_page(referrer, page) -> Column:
    """The page for visits from inside the site, else the empty string."""
    return F.when(F.col(referrer) == "Internal", page).otherwise(F.lit(""))


def classify_action(number, modulus) -> Column:
    """Remainder 0 is a purchase, 1 an addition to the cart, anything else a page view."""
    remainder = F.pmod(number, modulus)
    return (
        F.when(remainder == 0, "purchase")
        .when(remainder == 1, "add_to_cart")
        .otherwise("page_view")
    )
