"""What snapshot texts turn out to be: readable documents, or damaged ones that must not pass for empty ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from punctuality.schemas import SNAPSHOT

#: Every visit list could be read.
GOOD = "ok"
#: Some field has another type than stated; what could be read is used.
PARTIAL = "partial"
#: An object without a list of deliveries: nothing to use, and nothing wrong.
WITHOUT_DELIVERIES = "without_deliveries"
#: Nothing but white space.
EMPTY = "empty"
#: Not one whole JSON value: cut off, other text, or more text behind it.
UNREADABLE = "unreadable"
#: JSON, but a list or a single value.
NOT_AN_OBJECT = "not_an_object"
#: Statuses of documents that are set aside until a mended one takes their place.
DAMAGED = (EMPTY, UNREADABLE, NOT_AN_OBJECT)

_REST = "rest"
_PARSED = StructType([*SNAPSHOT.fields, StructField(_REST, StringType(), True)])
#: As strict as the collector's own reader.
_STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REST, "allowSingleQuotes": "false"}


def is_damaged(status: Column) -> Column:
    return status.isin(*DAMAGED)


def examine(texts: DataFrame, document: str = "document") -> DataFrame:
    """``texts`` with their ``status`` and the parsed ``Siri``; for batch and streaming frames alike.

    A file of white space counts as empty, and so does a missing text. Spark's readers pass over files of no bytes at all;
    these are known from the collector's reports alone. The parser takes the first value of a text and
    ignores what follows it; set in brackets, the whole text must be a list of one value, which tells more text behind it.
    """
    text = F.col(document)
    one_value = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False))
    # A one-element unnest, so that the text is parsed once however often its parts are used.
    parsed = texts.withColumn("parsed", F.explode(F.array(F.struct(F.from_json(text, _PARSED, _STRICT).alias("value"), one_value.alias("whole")))))
    start = F.substring(F.ltrim(text, F.lit(" \r\n\t")), 1, 1)
    value, whole = F.col("parsed.value"), F.col("parsed.whole")
    deliveries = value["Siri"]["ServiceDelivery"]["StopMonitoringDelivery"]
    status = (
        F.when(F.coalesce(start, F.lit("")) == "", EMPTY)
        .when(~whole, UNREADABLE)
        .when(value[_REST].isNotNull() & value["Siri"].isNull(), F.when(start == "{", UNREADABLE).otherwise(NOT_AN_OBJECT))
        .when(value[_REST].isNotNull(), PARTIAL)
        .when(deliveries.isNull(), WITHOUT_DELIVERIES)
        .otherwise(GOOD)
    )
    return parsed.withColumn("status", status).withColumn("Siri", F.when(~is_damaged(F.col("status")), value["Siri"])).drop("parsed")
