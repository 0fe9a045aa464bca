"""Schemas of the input files."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _record(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


REVIEW = _record(
    review_id=StringType(),
    user_id=StringType(),
    business_id=StringType(),
    stars=DoubleType(),
    useful=IntegerType(),
    funny=IntegerType(),
    cool=IntegerType(),
    text=StringType(),
    date=StringType(),
)
BUSINESS = _record(
    business_id=StringType(),
    city=StringType(),
    stars=DoubleType(),
    review_count=IntegerType(),
    is_open=IntegerType(),
)
TIP = _record(business_id=StringType())
PHOTO = _record(business_id=StringType(), photo_id=StringType())
RATING = _record(user_id=StringType(), business_id=StringType(), stars=DoubleType())
