"""Procurement- and mobility-shaped views over the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arriero.functions.calendar import month_of
from arriero.functions.identity import is_natural_person
from arriero.operators.dedupe import keep_latest
from arriero.sinks.tables import written
from arriero.sources.positions import parse_positions

ITEM_ORDER = ["fecha_ultima_modificacion", "total_linea_neto", "codigo_proveedor"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its file footer is read for the schema once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item versions with the few columns everything else about a line follows from; what shuffles carry."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_item"),
        "l_orderkey", "l_partkey", F.col("l_suppkey").cast("string").alias("codigo_proveedor"),
        F.col("l_shipdate").cast("date").alias("fecha_ultima_modificacion"), "l_quantity",
        F.col("l_extendedprice").cast("decimal(20,4)").alias("total_linea_neto"), "l_linestatus",
    )


def named_lines(lines: DataFrame) -> DataFrame:
    """Lines with the columns that follow from those of ``line_keys``; added behind the shuffles."""
    return lines.select(
        "*", F.col("codigo_proveedor").cast("bigint").alias("l_suppkey"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("codigo_proveedor")).alias("codigo"),
        F.col("l_quantity").cast("decimal(20,4)").alias("cantidad"), F.col("l_linestatus").alias("unidad_medida"),
    ).drop("l_quantity", "l_linestatus")


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item versions straight from ``lineitem``, several per ``id_item``."""
    return named_lines(line_keys(spark, sf_dir)).select(
        "id_item", "l_orderkey", "l_partkey", "l_suppkey", "codigo", "codigo_proveedor", "fecha_ultima_modificacion",
        "cantidad", "total_linea_neto", "unidad_medida")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier attributes with a synthetic tax id."""
    digit = F.col("s_suppkey") % 11
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("s_name").alias("nombre_proveedor"),
        F.concat(
            (F.lit(1000000) + (F.col("s_suppkey") * 7919003) % 98000000).cast("string"), F.lit("-"),
            F.when(digit == 10, "K").otherwise(digit.cast("string")),
        ).alias("rut_proveedor"),
        F.col("s_nationkey").cast("string").alias("region_proveedor"),
    )


def order_keys(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Orders with the few columns of order and buyer that the headers follow from."""
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    buyer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return orders.join(buyer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderstatus", "o_orderpriority", *buyer.columns)


def named_orders(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any rows with the columns of ``order_keys`` with the header columns instead; the 25 nations come last."""
    own = [c for c in orders.columns if c not in ("o_orderdate", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "mes")]
    agency = (
        table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    day = F.col("o_orderdate").cast("date")
    return orders.join(agency, F.col("c_nationkey") == F.col("n_nationkey")).select(
        *own,
        F.col("mes") if "mes" in orders.columns else month_of("o_orderdate").alias("mes"),
        day.alias("fecha_envio"), day.alias("fecha_creacion"),
        F.col("o_orderstatus").alias("tipo"),
        F.ascii("o_orderstatus").alias("codigo_estado"),
        (F.col("o_orderpriority") == "1-URGENT").alias("es_trato_directo"),
        (F.col("o_orderpriority") == "5-LOW").alias("es_compra_agil"),
        F.col("n_nationkey").cast("string").alias("codigo_organismo"),
        F.col("n_name").alias("nombre_organismo"),
        F.col("r_name").alias("sector"),
        F.col("c_custkey").cast("string").alias("codigo_unidad"),
        F.col("c_name").alias("nombre_unidad"),
        F.col("c_mktsegment").alias("region_unidad"),
    )


def order_headers(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Order-level columns: dates, buyer and purchase type."""
    return named_orders(order_keys(spark, sf_dir, orders), spark, sf_dir)


def latest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last modified version of each item, with the columns of ``line_keys``."""
    return keep_latest(line_keys(spark, sf_dir), ["id_item"], ITEM_ORDER)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("producto_generico"),
        F.col("p_type").alias("rubro_n1"), F.col("p_brand").alias("rubro_n2"), "p_size", "p_retailprice")


def decorated(lines: DataFrame, spark: SparkSession, sf_dir: str, dealt_by_order: bool = False) -> DataFrame:
    """Lines (columns of ``line_keys`` and any more) with item, order, buyer, supplier and product columns.

    Lines and order headers both grow with the data, so that join is never a broadcast; the hint also lets AQE split a
    dominant order. Shuffles carry the keys and what cannot be derived; all other columns are added behind the last one. Products
    and suppliers are joined before the wider headers, unless the lines are ``dealt_by_order`` already.
    """
    supplier = suppliers(spark, sf_dir).withColumn("codigo_proveedor", F.col("l_suppkey").cast("string")).select(
        "codigo_proveedor", "nombre_proveedor", "rut_proveedor", "region_proveedor")
    headers, products = order_keys(spark, sf_dir).hint("merge"), parts(spark, sf_dir)
    if dealt_by_order:
        keyed = lines.join(headers, "l_orderkey").join(products, "l_partkey").join(supplier, "codigo_proveedor")
    else:
        keyed = lines.join(products, "l_partkey").join(supplier, "codigo_proveedor").join(headers, "l_orderkey")
    return (
        named_lines(named_orders(keyed, spark, sf_dir))
        .withColumn("rubro_n3", F.col("p_size").cast("string"))
        .withColumn("precio_neto", F.col("p_retailprice").cast("decimal(20,4)"))
        .withColumn("es_persona_natural", is_natural_person("rut_proveedor"))
        .withColumn("codigo_producto_onu", F.col("l_partkey").cast("string"))
        .withColumn("moneda_oc", F.lit("CLP"))
        .withColumn("moneda_item", F.lit("CLP"))
        .withColumn("codigo_licitacion", F.lit(None).cast("string"))
        .drop("l_orderkey", "l_suppkey", "l_partkey", "p_size", "p_retailprice")
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items without the order amount."""
    return decorated(latest_keys(spark, sf_dir), spark, sf_dir)


def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated items; the order amount repeats on each item of the order, as in the source files.

    ``codigo`` names an order and a supplier, so the amount is a sum over the two, on the partitions that the join with the headers needs.
    """
    amount = F.sum("total_linea_neto").over(Window.partitionBy("l_orderkey", "codigo_proveedor")).cast("decimal(20,4)")
    known = F.col("l_orderkey").isNotNull() & F.col("codigo_proveedor").isNotNull()  # the joins drop the others
    lines = latest_keys(spark, sf_dir).where(known).repartition("l_orderkey").withColumn("monto_total_oc_clp", amount)
    return (
        decorated(lines, spark, sf_dir, dealt_by_order=True)
        .withColumn("monto_total_oc", F.col("monto_total_oc_clp"))
        .withColumn("total_neto_oc", F.col("monto_total_oc_clp"))
    )


def orders(spark: SparkSession, sf_dir: str, since: Column | None = None) -> DataFrame:
    """Order grain with the names of agency and supplier: lines are summed per order before anything is joined.

    With ``since`` only orders from that moment on: their keys reach the lines before these are deduplicated and summed.
    """
    lines, headers = item_lines(spark, sf_dir), order_headers(spark, sf_dir).hint("merge")
    if since is not None:
        recent = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= since)
        lines = lines.join(recent.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        headers = order_headers(spark, sf_dir, recent)
    totals = keep_latest(lines, ["id_item"], ITEM_ORDER).groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("total_linea_neto").cast("decimal(20,4)").alias("monto_total_oc_clp"))
    return totals.join(headers, "l_orderkey").join(suppliers(spark, sf_dir), "l_suppkey").select(
        "mes", "codigo_organismo", "nombre_organismo", "sector", F.col("l_suppkey").cast("string").alias("codigo_proveedor"),
        "nombre_proveedor", "rut_proveedor", "monto_total_oc_clp", "es_trato_directo", "es_compra_agil",
    )


# Cut between the two loads of the overwrite-in-place dimensions.
SECOND_LOAD_FROM = "1998-07"


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk file's text columns for every item version, with blanks, padding, quotes and line breaks to parse.

    The text is made behind the last shuffle, where it is written.
    """
    rows = decorated(line_keys(spark, sf_dir), spark, sf_dir)

    def text(c: str):
        return F.translate(F.col(c).cast("string"), ".", ",")

    def flag(c: str):
        return F.when(F.col(c), "Si").otherwise("No")

    blank, none = F.lit(""), F.lit(None).cast("string")
    title = F.concat(F.lit("Orden "), "codigo", F.lit('; "'), "rubro_n2", F.lit('"\n'), "rubro_n1")
    columns = {
        "IDItem": F.col("id_item").cast("string"), "ID": F.col("id_item").cast("string"), "Codigo": F.col("codigo"),
        "Nombre": title, "Tipo": F.col("tipo"), "EsTratoDirecto": flag("es_trato_directo"),
        "EsCompraAgil": flag("es_compra_agil"), "codigoEstado": F.col("codigo_estado").cast("string"), "Estado": none,
        "FechaCreacion": F.date_format("fecha_creacion", "yyyy-MM-dd"), "FechaEnvio": F.date_format("fecha_envio", "yyyy-MM-dd"),
        "FechaAceptacion": F.lit("sin fecha"),
        "fechaUltimaModificacion": F.date_format("fecha_ultima_modificacion", "yyyy-MM-dd"),
        "TipoMonedaOC": F.col("moneda_oc"), "MontoTotalOC": text("total_linea_neto"),
        "MontoTotalOC_PesosChilenos": text("total_linea_neto"), "TotalNetoOC": F.lit("1.234,56"), "PorcentajeIva": F.lit("19,0"),
        "CodigoOrganismoPublico": F.col("codigo_organismo"), "OrganismoPublico": F.col("nombre_organismo"),
        "sector": F.col("sector"), "RutUnidadCompra": none, "CodigoUnidadCompra": F.col("codigo_unidad"),
        "UnidadCompra": F.col("nombre_unidad"), "RegionUnidadCompra": F.concat(F.lit("  "), "region_unidad", F.lit(" ")),
        "CodigoProveedor": F.col("codigo_proveedor"), "NombreProveedor": F.concat(F.lit("Ñuñoa "), "nombre_proveedor"),
        "RutSucursal": F.col("rut_proveedor"), "ActividadProveedor": none, "RegionProveedor": F.col("region_proveedor"),
        "CodigoLicitacion": blank, "Codigo_ConvenioMarco": blank, "codigoProductoONU": F.col("codigo_producto_onu"),
        "NombreroductoGenerico": F.col("producto_generico"), "RubroN1": F.col("rubro_n1"), "RubroN2": F.col("rubro_n2"),
        "RubroN3": F.col("rubro_n3"), "cantidad": F.concat(F.lit(" "), text("cantidad")), "UnidadMedida": F.col("unidad_medida"),
        "monedaItem": F.col("moneda_item"), "precioNeto": text("precio_neto"), "totalLineaNeto": text("total_linea_neto"),
    }
    return rows.select(*[c.alias(name) for name, c in columns.items()], "mes")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order JSON, one version per item line of the order."""
    rows = decorated(line_keys(spark, sf_dir), spark, sf_dir)
    stamp = F.concat(F.date_format("fecha_ultima_modificacion", "yyyy-MM-dd"), F.lit("T10:30:00.5"))
    document = F.struct(
        F.col("codigo").alias("Codigo"), F.concat(F.lit("Orden ñ "), "rubro_n2").alias("Nombre"),
        F.col("codigo_estado").alias("CodigoEstado"), F.lit("").alias("CodigoLicitacion"), F.col("tipo").alias("Tipo"),
        F.lit("CLP").alias("TipoMoneda"), F.col("total_linea_neto").cast("double").alias("TotalNeto"),
        F.lit(19.0).alias("PorcentajeIva"), F.col("total_linea_neto").cast("double").alias("Total"),
        F.struct(
            F.date_format("fecha_creacion", "yyyy-MM-dd'T'HH:mm:ss").alias("FechaCreacion"), F.lit("nunca").alias("FechaEnvio"),
            stamp.alias("FechaUltimaModificacion"),
        ).alias("Fechas"),
        F.struct(
            F.col("codigo_organismo").alias("CodigoOrganismo"), F.col("nombre_organismo").alias("NombreOrganismo"),
            F.col("codigo_unidad").alias("CodigoUnidad"), F.col("region_unidad").alias("RegionUnidad"),
        ).alias("Comprador"),
        F.struct(
            F.col("codigo_proveedor").alias("Codigo"), F.col("nombre_proveedor").alias("Nombre"),
            F.col("rut_proveedor").alias("RutSucursal"), F.lit("").alias("Region"),
        ).alias("Proveedor"),
        F.struct(F.col("cantidad").cast("double").alias("Cantidad")).alias("Items"),
    )
    return rows.select(F.to_json(document).alias("value"))


def buyer_snapshots(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """One row per buyer and period (``month`` or ``year``): a tracked, an overwritten and a passive attribute."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("codigo"), F.date_trunc(unit, "o_orderdate").cast("date").alias("desde"))
        .agg(F.max("o_orderpriority").alias("nombre"), F.max("o_orderstatus").alias("region"),
             F.bool_or(F.col("o_totalprice") > 300000).alias("persona"))
    )


def months_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of any order or shipment; the last ones have no order."""
    placed = table(spark, sf_dir, "orders").select(month_of("o_orderdate").alias("mes"))
    shipped = table(spark, sf_dir, "lineitem").select(month_of("l_shipdate").alias("mes"))
    return placed.unionByName(shipped).distinct()


RUN_AT = "2024-02-01 00:00:00"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order month with an age of 0 to 41 hours and a fingerprint."""
    n = F.col("n")
    return (
        table(spark, sf_dir, "orders").groupBy(month_of("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
        .select(
            "mes", F.concat(F.lit("compras/mes="), "mes", F.lit("/archivo.csv")).alias("ruta"),
            (F.lit(RUN_AT).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), (n % 80 * 31).cast("int"))).alias("modificado"),
            n.cast("string").alias("huella"),
        )
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was loaded before: some months are missing, some have another fingerprint."""
    month = F.substring("mes", 6, 2).cast("int")
    return listing(spark, sf_dir).where(month % 3 != 0).select(
        "mes", F.when(month % 3 == 1, F.concat(F.lit("x"), "huella")).otherwise(F.col("huella")).alias("huella")
    )


def volume_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two logged volume measures per order month; the newer one counts."""
    n = F.col("n").cast("decimal(20,2)")
    per_month = table(spark, sf_dir, "orders").groupBy(month_of("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
    runs = F.explode(F.array(
        F.struct(F.lit("2024-01-30 00:00:00").cast("timestamp_ntz").alias("ejecutado_en"), (n * 9).cast("decimal(20,2)").alias("valor")),
        F.struct(F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias("ejecutado_en"),
                 (n * F.lit("3.3").cast("decimal(3,1)")).cast("decimal(20,2)").alias("valor")),
    )).alias("r")
    return per_month.select("mes", runs).select(
        F.lit("volumen_items").alias("chequeo"), "mes", F.lit("ok").alias("estado"), "r.valor", "r.ejecutado_en",
        F.xxhash64("mes", "r.ejecutado_en").alias("chequeo_id"),
    )


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a check log."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("chequeo_id"), F.col("ts").alias("ejecutado_en"), F.col("event_type").alias("chequeo"),
        month_of("ts").alias("mes"), F.when(F.col("event_type") == "error", "falla").otherwise("ok").alias("estado"),
        F.col("value").cast("decimal(20,2)").alias("valor"), F.lit(None).cast("string").alias("esperado"),
        F.col("props").alias("detalle"),
    )


def position_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delimited position texts, polled on the hour; some are short, blank or badly dated."""
    e = table(spark, sf_dir, "events")
    poll = F.date_trunc("hour", "ts").cast("timestamp_ntz") + F.expr("interval 1 hour")
    id_ = F.col("event_id")
    stamp = F.when(id_ % 30 == 17, "2024/01/xx").otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
    lat = F.when(id_ % 30 == 7, "").otherwise(F.concat(F.lit("-33."), F.lpad((id_ % 10000).cast("string"), 4, "0")))
    fields = [
        stamp, F.col("user_id").cast("string"), lat, F.concat(F.lit("-70."), F.lpad((id_ % 7919).cast("string"), 4, "0")),
        F.col("value").cast("decimal(10,2)").cast("string"), (id_ % 8).cast("string"), (id_ % 6).cast("string"),
        F.col("event_type"), F.when(id_ % 2 == 0, "I").otherwise("R"), F.concat("event_type", F.lit(" 00")), F.lit(""),
        F.date_format("ts", "dd-MM-yyyy HH:mm:ss"),
    ]
    whole = F.concat_ws(";", *fields)
    record = F.when(id_ % 30 == 3, F.concat_ws(";", *fields[:5])).when(id_ % 3 == 0, F.concat_ws(";", whole, whole, F.lit("")))
    return e.select(
        record.otherwise(F.concat(whole, F.lit(";"))).alias("registro"),
        F.date_format(poll, "yyyyMMddHHmmss").alias("consulta"), poll.alias("ahora"), "event_id",
    )


def vehicle_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest parsed position per vehicle, whatever its age."""
    always = F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    return keep_latest(parse_positions(position_records(spark, sf_dir), always), ["patente"], ["gps", "latitud", "longitud", "velocidad", "servicio"])


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the service dictionary: brand is the service, part key the route."""
    suffix = F.element_at(F.array(F.lit("I"), F.lit("R"), F.lit("X")), (F.col("p_partkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("codigo_usuario"), F.concat(F.lit("M"), F.col("p_size")).alias("codigo_mtt"),
        F.concat(F.col("p_partkey").cast("string"), suffix).alias("codigo_ruta"), F.col("p_name").alias("servicio_deco"),
        F.col("p_type").alias("tipo_servicio"), F.concat("p_type", F.lit(" SA")).alias("cli_dsc"),
    )


def order_month_list(df: DataFrame, key: str = "mes") -> list[str]:
    """The months a table holds: a list bounded by the calendar."""
    return sorted(r[0] for r in df.select(key).distinct().collect())
