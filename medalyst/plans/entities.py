"""Bronze rows to silver entities: drop quarantined keys, standardise, keep the newest version, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.contracts import Contract
from medalyst.functions.columns import tidy
from medalyst.operators.dedupe import latest_per_key
from medalyst.operators.relational import without_keys
from medalyst.sources.upsert import UpsertTable


def standardised(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract casing and types for the columns present; text that does not parse becomes NULL."""
    out = {}
    for f in contract.columns:
        if f.name not in df.columns:
            continue
        if f.name in contract.casing:
            out[f.name] = tidy(f.name, contract.casing[f.name])
        elif f.name in contract.date_columns:
            out[f.name] = F.col(f.name).try_cast("date")
        elif df.schema[f.name].dataType.typeName() == "string" and f.dataType.typeName() != "string":
            out[f.name] = F.col(f.name).try_cast(f.dataType)
    return df.withColumns(out) if out else df


def to_silver(bronze: DataFrame, contract: Contract, quarantine: DataFrame | None = None, as_of: Column | None = None,
              tiebreak: Sequence[str] = ()) -> DataFrame:
    """One clean row per key, projected to the contract and stamped.

    A quarantined key loses all its versions, so it does not matter whether keys
    are dropped before or after the newest version is chosen. Choosing first
    lets each scan task reduce a hot key to one row before any shuffle.
    """
    newest = latest_per_key(bronze, [contract.key], "ingestion_ts", tiebreak)
    kept = newest if quarantine is None else without_keys(newest, quarantine, [contract.key])
    tagged = standardised(kept, contract).withColumns({
        "silver_ingestion_ts": F.current_timestamp() if as_of is None else as_of,
        "record_source": F.col("source_file") if "source_file" in bronze.columns else F.lit(None).cast("string")})
    return tagged.select(*[c for c in contract.silver_columns if c in tagged.columns])


def load_silver(table: UpsertTable, bronze: DataFrame, contract: Contract, **options) -> list[str]:
    """Upsert the silver form of ``bronze`` into its table; a late batch of older versions loses.

    The table has one column more than the silver form: ``version_ts``, the newest ``ingestion_ts`` of each key.
    """
    silver = to_silver(bronze, contract, **options)
    versions = bronze.groupBy(contract.key).agg(F.max("ingestion_ts").alias("version_ts"))
    return table.merge(silver.join(versions, contract.key), newest_by="version_ts")
