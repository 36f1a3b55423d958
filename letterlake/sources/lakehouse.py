"""The four source tables of the semantic layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterlake import schemas

LANDING_EVENTS = "landing_events"
DIM_CUSTOMER_TENANT = "dim_customer_tenant"
DIM_CUSTOMER_EVENT_TYPE = "dim_customer_event_type"
FCT_DAILY_CUSTOMER_DELIVERY = "fct_daily_customer_delivery"

SOURCE_TABLES = {
    LANDING_EVENTS: schemas.LANDING,
    DIM_CUSTOMER_TENANT: schemas.DIM_CUSTOMER_TENANT,
    DIM_CUSTOMER_EVENT_TYPE: schemas.DIM_CUSTOMER_EVENT_TYPE,
    FCT_DAILY_CUSTOMER_DELIVERY: schemas.FCT_DAILY_DELIVERY,
}


def source_table(spark: SparkSession, name: str, *, root: str | None = None, catalog: str | None = None) -> DataFrame:
    """A source table from a folder of parquet tables or from a catalog namespace, columns by schema."""
    schema = SOURCE_TABLES[name]
    if catalog:
        return spark.table(f"{catalog}.{name}").select(*schema.fieldNames())
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def create_tables(spark: SparkSession, namespace: str, provider: str = "parquet") -> None:
    """Declares the source tables in a catalog namespace, partitioned by day where they hold days.

    With ``provider="iceberg"`` the landing table takes the day transform of the event time and the
    tenant as a sort order; file formats without transforms partition by the date column.
    """
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    for name, schema in SOURCE_TABLES.items():
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
        layout = ""
        if "event_date" in schema.fieldNames():
            by_day = provider == "iceberg" and "event_ts" in schema.fieldNames()
            layout = "PARTITIONED BY (days(event_ts))" if by_day else "PARTITIONED BY (event_date)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({columns}) USING {provider} {layout}")
