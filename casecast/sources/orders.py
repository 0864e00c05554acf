"""A case table over the `orders` test table: one case per order, with every null and spelling the rules care about."""


def orders_as_cases_sql(orders="orders"):
    """Text that Spark SQL and DuckDB both run."""
    return f"""
    SELECT o_orderkey AS case_id,
     CASE WHEN o_custkey % 20 = 0 THEN NULL WHEN o_custkey % 20 = 1 THEN 'NR'
          WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sexo,
     CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN CAST(30 + o_custkey % 60 AS INT)
          ELSE CAST(o_custkey % 100 AS INT) END AS edad,
     CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha_inicio_sintomas,
     CASE WHEN o_orderkey % 3 = 0 THEN NULL
          ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 21 - 2 AS INT) END AS fecha_internacion,
     CASE WHEN o_orderpriority = '1-URGENT' THEN 'SI' WHEN o_orderpriority = '2-HIGH' THEN 'si'
          WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'NO' END AS cuidado_intensivo,
     CASE WHEN o_orderstatus = 'F' THEN 'SI' ELSE 'NO' END AS asistencia_respiratoria_mecanica,
     CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN 'Caso confirmado - Fallecido'
          WHEN o_custkey % 100 >= 75 AND o_totalprice > 400000 THEN 'Fallecido'
          WHEN o_totalprice > 480000 THEN 'Caso confirmado - fallecido'
          WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'Caso confirmado - No activo' END AS clasificacion,
     CASE WHEN o_orderkey % 5 = 0 THEN NULL
          ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) END AS fecha_diagnostico,
     CASE WHEN o_orderkey % 17 = 0 THEN 'Descartado' WHEN o_orderkey % 19 = 0 THEN NULL
          ELSE 'Confirmado' END AS clasificacion_resumen
    FROM {orders}"""


def cases_from_orders(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(orders_as_cases_sql("{orders}"), orders=orders)
