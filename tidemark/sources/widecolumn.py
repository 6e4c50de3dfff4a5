"""Wide-column tables kept as cells ``(rowkey, family, qualifier, value, version)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import parse_ddl


def row_layout(schema: StructType | str) -> tuple[str, dict[str, StructType]]:
    """Row-key name and the families of a nested schema.

    The one field that is not a nested row is the row key, each nested row a family.
    """
    declared = parse_ddl(schema) if isinstance(schema, str) else schema
    keys = [f.name for f in declared if not isinstance(f.dataType, StructType)]
    families = {
        f.name: f.dataType for f in declared if isinstance(f.dataType, StructType)
    }
    if len(keys) != 1:
        raise ValueError(f"exactly one row key is needed, found {keys}")
    if not families:
        raise ValueError("at least one column family is needed")
    return keys[0], families


def read_rows(
    cells: DataFrame, schema: StructType | str, families: Sequence[str] | None = None
) -> DataFrame:
    """Newest cell values as nested rows, only for the requested families.

    Cells of other families and qualifiers are filtered out before the shuffle on
    the row key, and each map task sends one partial per row key.
    """
    key, declared = row_layout(schema)
    wanted = list(declared) if families is None else list(families)
    unknown = [name for name in wanted if name not in declared]
    if unknown:
        raise ValueError(f"no such families: {unknown}")
    columns = [(family, q) for family in wanted for q in declared[family]]
    asked_for = F.lit(False)
    newest = []
    for position, (family, qualifier) in enumerate(columns):
        here = (F.col("family") == family) & (F.col("qualifier") == qualifier.name)
        asked_for = asked_for | here
        newest.append(
            F.max(F.when(here, F.struct("version", "value"))).alias(f"_c{position}")
        )
    packed = (
        cells.filter(asked_for).groupBy(F.col("rowkey").alias(key)).agg(*newest)
    )
    rows = []
    for name in wanted:
        fields = [
            F.col(f"_c{position}.value").cast(qualifier.dataType).alias(qualifier.name)
            for position, (family, qualifier) in enumerate(columns)
            if family == name
        ]
        rows.append(F.struct(*fields).alias(name))
    return packed.select(key, *rows)
