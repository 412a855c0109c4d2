"""Source rows to the unified quote contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.schemas import UNIFIED_CONTRACT
from quotelake.specs import SourceSpec


def unify(accepted: DataFrame, spec: SourceSpec, loaded_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Map accepted rows to the contract; metrics the source lacks are NULL.

    Symbols are upper-cased here only; ``source_updated_at`` is the load time.
    """
    mapping = spec.mapping()
    columns = []
    for target in UNIFIED_CONTRACT:
        if target.name == "source":
            value = F.lit(spec.name)
        elif target.name == "source_updated_at":
            value = loaded_at
        elif target.name in mapping:
            source_field = mapping[target.name]
            value = F.col(source_field.name)
            value = F.upper(value) if source_field.upper else value
        else:
            value = F.lit(None).cast(target.dataType)
        columns.append(value.alias(target.name))
    return accepted.select(*columns, *keep)


def meets_contract(df: DataFrame) -> DataFrame:
    """Shape rows to the contract and keep those whose required columns are set."""
    required = [F.col(f.name).isNotNull() for f in UNIFIED_CONTRACT if not f.nullable]
    shaped = df.select(*[F.col(f.name).cast(f.dataType) for f in UNIFIED_CONTRACT])
    return shaped.filter(reduce(lambda a, b: a & b, required))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
