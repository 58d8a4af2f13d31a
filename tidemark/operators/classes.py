"""Class catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def compact_class_ids(names: DataFrame) -> DataFrame:
    """Catalog from keyed names: sorted by key then name, blanks dropped, and the position
    becomes the class id, so gaps in the keys close.

    Rows that agree in key and name are the same pair to the order, whichever comes first. A catalog
    comes from one document, which was held in one row already, so a window may gather it.
    """
    stripped = names.select("dataset_id", "name_key", strip(F.col("raw_name")).alias("class_name"))
    present = stripped.where(F.col("class_name") != "")
    in_order = Window.partitionBy("dataset_id").orderBy("name_key", "class_name")
    number = (F.row_number().over(in_order) - 1).cast("int")
    return present.select("dataset_id", number.alias("class_id"), "class_name")
