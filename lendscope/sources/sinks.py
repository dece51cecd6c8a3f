"""Parquet, JDBC, metric and model sinks.

A failing sink raises. The caller learns where data went from the return value; there is no
silent change of format.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx


def project_existing(df: DataFrame, columns) -> DataFrame | None:
    """The listed columns that exist, in list order; None when there is none."""
    present = [c for c in columns if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in present]) if present else None


def star_tables(df: DataFrame, tables: Mapping[str, tuple] = fx.STAR_TABLES) -> dict[str, DataFrame]:
    """Fact and dimension projections of the flat feature table, absent ones left out."""
    projected = {name: project_existing(df, columns) for name, columns in tables.items()}
    return {name: t for name, t in projected.items() if t is not None}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None,
                  only_present: bool = False) -> str:
    """Write ``df``, in folders by ``partition_by`` where it has that column.

    ``only_present`` replaces the folders of the values that ``df`` has and leaves all others as they are. Rows of a value
    are gathered before they are written, large values in several files, so that no task writes a file for every value.
    """
    if partition_by is None or partition_by not in df.columns:
        df.write.mode(mode).parquet(path)
        return path
    if only_present:
        df = df.hint("rebalance", F.col(f"`{partition_by}`"))
    writer = df.write.mode(mode).partitionBy(partition_by)
    if only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def write_star_parquet(df: DataFrame, base: str, dataset: str, rebuild: bool = True, partition_by: str | None = None) -> list[str]:
    """The flat table, then the star tables as projections of what was written.

    Reading the written table back means the feature plan runs once, not once per table.
    ``rebuild=False`` keeps whatever is already there (S12). With ``partition_by`` tables that have that column lie in a
    folder per value, and a rebuild replaces only the values that ``df`` has: a new year adds its folder, a corrected one
    takes the place of its own, and neither reads nor writes the others. Star tables without the column follow the whole
    flat table.
    """
    mode = "overwrite" if rebuild else "ignore"
    flat_path = write_parquet(df, f"{base}/{dataset}_features.parquet", mode, partition_by, bool(partition_by))
    spark = df.sparkSession
    flat = spark.read.parquet(flat_path)
    if not partition_by or partition_by not in flat.columns:
        return [flat_path] + [write_parquet(table, f"{base}/{dataset}_{name}.parquet", mode) for name, table in star_tables(flat).items()]
    values = [r[0] for r in df.select(F.col(f"`{partition_by}`")).distinct().collect()]  # one per folder
    column = F.col(f"`{partition_by}`")
    touched = flat.where(column.isin([v for v in values if v is not None]) | (column.isNull() if None in values else F.lit(False)))
    paths = [flat_path]
    for name, table in star_tables(flat).items():
        some = star_tables(touched)[name] if partition_by in table.columns else table
        paths.append(write_parquet(some, f"{base}/{dataset}_{name}.parquet", mode, partition_by, True))
    return paths


def jdbc_tables(df: DataFrame, dataset: str) -> dict[str, DataFrame]:
    """Table name to frame for the relational layout: the flat table and narrow star tables."""
    tables = {f"{dataset}_features": df}
    for name, table in star_tables(df, fx.STAR_TABLES_JDBC).items():
        tables[f"{dataset}_{name}"] = table
    return tables


def write_jdbc(
    df: DataFrame,
    url: str,
    dataset: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_rows: int = 10_000,
) -> list[str]:
    """Replace the dataset's tables over JDBC with a bounded number of connections."""
    options = {"numPartitions": str(connections), "batchsize": str(batch_rows), **(properties or {})}
    written = []
    for name, table in jdbc_tables(df, dataset).items():
        table.write.jdbc(url, name, mode="overwrite", properties=options)
        written.append(name)
    return written


def write_feature_store(df: DataFrame, dataset: str, target: str, output_format: str = "parquet", **options) -> list[str]:
    """Write to the named sink ("parquet" path or "jdbc" url) and list what was written."""
    if output_format == "parquet":
        return write_star_parquet(df, target, dataset, **options)
    if output_format == "jdbc":
        return write_jdbc(df, target, dataset, **options)
    raise ValueError(f"unknown output format: {output_format}")


def write_result(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A small result frame (metrics, segments, importance) as JSON lines or CSV."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline. Only ``training.scoring_pipeline`` holds medians and scales as well as the model."""
    model.write().overwrite().save(path)
    return path
