"""The catalogue: every operator as a query over the test tables, with the SQL
that states the same result.

Sorting follows Spark (nulls least), so the SQL says where nulls go.  Sums of
doubles depend on the order of addition, so both sides round them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import col, lit
from ..operators.dictionary import coded
from ..session import Context
from ..sources import files
from ..table import Table
from .query import Query

Build = Callable[[Callable[[str], Table]], Query]

_BUILT: dict[str, tuple[Build, str, dict[str, int]]] = {}


def _query(name: str, sql: str, **rounded: int):
    """Register a query; ``rounded`` names outputs that both sides round."""

    def register(build: Build) -> Build:
        _BUILT[name] = (build, sql, rounded)
        return build

    return register


def _run(build: Build, rounded: dict[str, int]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = Context(spark)
        df = build(lambda name: context.read_parquet(f"{sf_dir}/{name}.parquet")).to_df()
        return df.withColumns({c: F.round(c, n) for c, n in rounded.items()})

    return run


# ---- filters

_query("q01_filter", "SELECT * FROM lineitem WHERE l_quantity > 45")(lambda t: t("lineitem").filter(col("l_quantity") > 45))
_query("q02_filter_chain", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_discount >= 0.05 AND l_returnflag = 'R'")(
    lambda t: t("lineitem").filter(col("l_quantity") > 45).filter(col("l_discount") >= 0.05).filter(col("l_returnflag") == "R")
)
_query("q03_eq_text", "SELECT * FROM orders WHERE o_orderstatus = 'F'")(lambda t: t("orders").filter(col("o_orderstatus").eq("F")))
for _op, _sign in (("ne", "<>"), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">="), ("eq", "=")):
    _query(f"q04_{_op}", f"SELECT * FROM lineitem WHERE l_quantity {_sign} 25")(lambda t, op=_op: t("lineitem").filter(getattr(col("l_quantity"), op)(25)))
_query("q05_and", "SELECT * FROM lineitem WHERE l_returnflag = 'A' AND l_quantity < 5")(lambda t: t("lineitem").filter((col("l_returnflag") == "A") & (col("l_quantity") < 5)))
_query("q05_or", "SELECT * FROM lineitem WHERE l_quantity > 49 OR l_discount = 0")(lambda t: t("lineitem").filter(col("l_quantity").gt(49).or_(col("l_discount").eq(0))))
_query("q05_not", "SELECT * FROM lineitem WHERE NOT (l_quantity > 5)")(lambda t: t("lineitem").filter((col("l_quantity") > 5).not_()))
for _op, _sign, _than in (("add", "+", 30), ("sub", "-", 20), ("mul", "*", 10)):
    _query(f"q06_{_op}", f"SELECT * FROM lineitem WHERE l_quantity {_sign} l_linenumber > {_than}")(
        lambda t, op=_op, than=_than: t("lineitem").filter(getattr(col("l_quantity"), op)(col("l_linenumber")) > than)
    )
_query("q06_reflected", "SELECT * FROM lineitem WHERE 1 - l_discount > 0.95 AND 2 * l_quantity < 20")(lambda t: t("lineitem").filter((1 - col("l_discount") > 0.95) & (2 * col("l_quantity") < 20)))
_query("q07_div_zero", "SELECT * FROM lineitem WHERE l_linenumber = 1")(lambda t: t("lineitem").filter(col("l_quantity").div(col("l_linenumber") - 1).is_null()))
_query("q08_mod_zero", "SELECT * FROM lineitem WHERE l_linenumber = 1")(lambda t: t("lineitem").filter(col("l_partkey").mod(col("l_linenumber") - 1).is_null()))
_query("q08_mod_negative", "SELECT * FROM customer WHERE c_acctbal % 7 < -3")(lambda t: t("customer").filter(col("c_acctbal") % 7 < -3))
_query("q10_log_negative", "SELECT * FROM customer WHERE c_acctbal <= 0")(lambda t: t("customer").filter(col("c_acctbal").log().is_null()))
_query("q10_sqrt_negative", "SELECT * FROM customer WHERE CASE WHEN c_acctbal < 0 THEN 'nan'::DOUBLE ELSE sqrt(c_acctbal) END > 50")(lambda t: t("customer").filter(col("c_acctbal").sqrt() > 50))
_query("q07_div", "SELECT * FROM orders WHERE o_totalprice / 1000 > 300")(lambda t: t("orders").filter(col("o_totalprice").div(1000) > 300))
_query("q08_mod", "SELECT * FROM orders WHERE o_orderkey % 7 = 3")(lambda t: t("orders").filter(col("o_orderkey") % 7 == 3))
_query("q09_neg", "SELECT * FROM customer WHERE -c_acctbal > 500")(lambda t: t("customer").filter(-col("c_acctbal") > 500))
_query("q09_abs", "SELECT * FROM supplier WHERE abs(s_acctbal) < 900")(lambda t: t("supplier").filter(col("s_acctbal").abs() < 900))
_query("q10_sqrt", "SELECT * FROM lineitem WHERE sqrt(l_quantity) >= 7")(lambda t: t("lineitem").filter(col("l_quantity").sqrt() >= 7))
_query("q10_log", "SELECT * FROM lineitem WHERE ln(l_quantity) < 1.5")(lambda t: t("lineitem").filter(col("l_quantity").log() < 1.5))
_query("q10_exp", "SELECT * FROM lineitem WHERE exp(l_discount) > 1.1")(lambda t: t("lineitem").filter(col("l_discount").exp() > 1.1))
_query("q11_ceil", "SELECT * FROM orders WHERE ceil(o_totalprice)::BIGINT % 2 = 0")(lambda t: t("orders").filter(col("o_totalprice").ceil() % 2 == 0))
_query("q11_floor", "SELECT * FROM orders WHERE floor(o_totalprice)::BIGINT % 2 = 1")(lambda t: t("orders").filter(col("o_totalprice").floor() % 2 == 1))
_query("q12_is_null", "SELECT * FROM lineitem WHERE l_extendedprice / NULLIF(l_discount, 0) IS NULL")(lambda t: t("lineitem").filter(col("l_extendedprice").div(col("l_discount")).is_null()))
_query("q12_is_not_null", "SELECT * FROM lineitem WHERE l_extendedprice / NULLIF(l_discount, 0) IS NOT NULL AND l_quantity < 3")(
    lambda t: t("lineitem").filter(~col("l_extendedprice").div(col("l_discount")).is_null()).filter(col("l_quantity") < 3)
)
_query("q29_literals", "SELECT * FROM events WHERE event_type = 'click' AND value > 20.5 AND user_id >= 10 AND TRUE")(
    lambda t: t("events").filter((col("event_type") == lit("click")) & (col("value") > lit(20.5)) & (col("user_id") >= lit(10)) & lit(True))
)
_query("q29_null_literal", "SELECT * FROM events WHERE value > NULL")(lambda t: t("events").filter(col("value") > lit(None)))
_query("q31_aggregate_in_filter", "SELECT * FROM lineitem WHERE l_quantity > (SELECT avg(l_quantity) FROM lineitem)")(lambda t: t("lineitem").filter(col("l_quantity") > col("l_quantity").mean()))

# ---- groups

_query(
    "q06_sum_of_expression",
    "SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS charge FROM lineitem GROUP BY ALL",
    charge=2,
)(lambda t: t("lineitem").group_by("l_returnflag").agg((col("l_extendedprice") * (1 - col("l_discount")) * (1 + col("l_tax"))).sum().alias("charge")))
_q13 = "SELECT l_returnflag, l_linestatus, {} FROM lineitem GROUP BY ALL"
_query("q13_aggregates", _q13.format("round(sum(l_quantity), 2) AS l_quantity_sum, min(l_tax) AS l_tax_min, max(l_tax) AS l_tax_max, count(l_partkey) AS l_partkey_count, round(avg(l_quantity), 6) AS l_quantity_mean"), l_quantity_sum=2, l_quantity_mean=6)(
    lambda t: t("lineitem").group_by("l_returnflag", "l_linestatus").agg(col("l_quantity").sum(), col("l_tax").min(), col("l_tax").max(), col("l_partkey").count(), col("l_quantity").mean())
)
_KEYS2 = ("l_returnflag", "l_linestatus")
_query("q13_sum_int", "SELECT l_returnflag, l_linestatus, sum(l_linenumber)::BIGINT AS l_linenumber_sum FROM lineitem GROUP BY ALL")(lambda t: t("lineitem").group_by(*_KEYS2).agg(col("l_linenumber").sum()))
for _op, _fn, _n in (("min", "min(l_extendedprice)", None), ("max", "max(l_extendedprice)", None), ("count", "count(l_extendedprice)", None), ("mean", "round(avg(l_extendedprice), 4)", 4)):
    _name = f"l_extendedprice_{_op}"
    _query(f"q13_{_op}", f"SELECT l_returnflag, l_linestatus, {_fn} AS {_name} FROM lineitem GROUP BY ALL", **({_name: _n} if _n else {}))(
        lambda t, op=_op: t("lineitem").group_by(*_KEYS2).agg(getattr(col("l_extendedprice"), op)())
    )
_query("q14_prod", "SELECT l_returnflag, round(product(1 - l_discount / 10000), 8) AS p FROM lineitem GROUP BY ALL", p=8)(
    lambda t: t("lineitem").group_by("l_returnflag").agg((1 - col("l_discount") / 10000).prod().alias("p"))
)
_query("q15_first", "SELECT event_type, first(value ORDER BY event_id) AS value_first FROM events GROUP BY ALL")(lambda t: t("events").sort("event_id").group_by("event_type").agg(col("value").first()))
_query("q15_last", "SELECT event_type, last(value ORDER BY event_id) AS value_last FROM events GROUP BY ALL")(lambda t: t("events").sort("event_id").group_by("event_type").agg(col("value").last()))
_query("q15_first_descending", "SELECT event_type, first(user_id ORDER BY event_id DESC) AS user_id_first FROM events GROUP BY ALL")(
    lambda t: t("events").sort("event_id", descending=True).group_by("event_type").agg(col("user_id").first())
)
_query("q15_last_descending", "SELECT event_type, last(user_id ORDER BY ts DESC, event_id) AS user_id_last FROM events GROUP BY ALL")(
    lambda t: t("events").sort("event_id").sort("ts", descending=True).group_by("event_type").agg(col("user_id").last())
)
_query("q15_first_by_text", "SELECT first(event_id ORDER BY event_type DESC, value DESC, event_id) AS event_id_first FROM events")(
    lambda t: t("events").sort("event_type", "value", "event_id", descending=[True, True, False]).group_by().agg(col("event_id").first())
)
_query("q15_first_of_groups", "SELECT first(event_type ORDER BY n DESC, event_type) AS event_type_first FROM (SELECT event_type, count(*) AS n FROM events GROUP BY ALL)")(
    lambda t: t("events").group_by("event_type").agg(col("event_id").count().alias("n")).sort("n", descending=True).group_by().agg(col("event_type").first())
)
_query("q16_alias", "SELECT l_linestatus, max(l_shipdate) AS latest FROM lineitem GROUP BY ALL")(lambda t: t("lineitem").group_by("l_linestatus").agg(col("l_shipdate").max().alias("latest")))
_query("q17_over_aggregates", "SELECT l_returnflag, round(sum(l_tax) / sum(l_discount), 6) AS ratio FROM lineitem GROUP BY ALL", ratio=6)(
    lambda t: t("lineitem").group_by("l_returnflag").agg((col("l_tax").sum() / col("l_discount").sum()).alias("ratio"))
)
_query("q18_bare_expression", "SELECT event_type, first(value + user_id ORDER BY event_id) AS both_of FROM events GROUP BY ALL")(
    lambda t: t("events").sort("event_id").group_by("event_type").agg((col("value") + col("user_id")).alias("both_of"))
)
_query("q19_global", "SELECT count(o_orderkey) AS n, max(o_totalprice) AS most FROM orders")(lambda t: t("orders").group_by().agg(col("o_orderkey").count().alias("n"), col("o_totalprice").max().alias("most")))
_query("q20_distinct_keys", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")(lambda t: t("lineitem").group_by("l_returnflag", "l_linestatus").agg())
_query("q21_having", "SELECT o_custkey, count(o_orderkey) AS o_orderkey_count FROM orders GROUP BY ALL HAVING count(o_orderkey) > 15")(
    lambda t: t("orders").group_by("o_custkey").agg(col("o_orderkey").count()).filter(col("o_orderkey_count") > 15)
)
_query("q22_filter_group", "SELECT l_linestatus, count(l_orderkey) AS l_orderkey_count FROM lineitem WHERE l_quantity > 30 GROUP BY ALL")(
    lambda t: t("lineitem").filter(col("l_quantity") > 30).group_by("l_linestatus").agg(col("l_orderkey").count())
)
_query("q27_group_of_groups", "SELECT l_returnflag, max(n) AS n_max FROM (SELECT l_returnflag, l_linestatus, count(l_orderkey) AS n FROM lineitem GROUP BY ALL) GROUP BY ALL")(
    lambda t: t("lineitem").group_by("l_returnflag", "l_linestatus").agg(col("l_orderkey").count().alias("n")).group_by("l_returnflag").agg(col("n").max())
)

# ---- sort and head

_query("q23_sort_asc", "SELECT * FROM orders ORDER BY o_totalprice NULLS FIRST, o_orderkey LIMIT 50")(lambda t: t("orders").sort("o_orderkey").sort("o_totalprice").head(50))
_query("q23_sort_desc", "SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 50")(lambda t: t("orders").sort("o_orderkey").sort("o_totalprice", descending=True).head(50))
_query("q23_sort_multi", "SELECT * FROM orders ORDER BY o_orderstatus DESC NULLS LAST, o_orderpriority NULLS FIRST, o_orderkey DESC LIMIT 200")(
    lambda t: t("orders").sort("o_orderstatus", "o_orderpriority", "o_orderkey", descending=[True, False, True]).head(200)
)
_query("q23_filter_sort", "SELECT * FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey")(lambda t: t("orders").filter(col("o_orderstatus") == "P").sort("o_orderkey"))
_query("q24_head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")(lambda t: t("orders").sort("o_orderkey").head(20))
_query("q24_filter_head", "SELECT * FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderkey LIMIT 20")(lambda t: t("orders").filter(col("o_totalprice") > 1000).sort("o_orderkey").head(20))
_query("q24_head_source_order", "SELECT * FROM orders LIMIT 20")(lambda t: t("orders").head(20))
_query("q24_filter_then_head", "SELECT * FROM orders WHERE o_totalprice > 100000 LIMIT 20")(lambda t: t("orders").filter(col("o_totalprice") > 100000).head(20))
_query("q24_head_beyond", "SELECT * FROM nation")(lambda t: t("nation").head(1_000_000))
_query("q24_head_zero", "SELECT * FROM nation WHERE FALSE")(lambda t: t("nation").head(0))
_query("q25_top_k", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")(lambda t: t("orders").sort("o_totalprice", "o_orderkey", descending=[True, False]).head(10))
_query("q26_head_then_group", "SELECT o_orderstatus, count(o_orderkey) AS n FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100) GROUP BY ALL")(
    lambda t: t("orders").sort("o_totalprice", "o_orderkey", descending=[True, False]).head(100).group_by("o_orderstatus").agg(col("o_orderkey").count().alias("n"))
)
_query(
    "q28_flagship",
    "SELECT l_returnflag, round(sum(l_extendedprice), 2) AS l_extendedprice_sum, round(avg(l_quantity), 6) AS l_quantity_mean FROM lineitem WHERE l_quantity > 10 GROUP BY ALL ORDER BY 2 DESC LIMIT 10",
    l_extendedprice_sum=2,
    l_quantity_mean=6,
)(lambda t: t("lineitem").filter(col("l_quantity") > 10).group_by("l_returnflag").agg(col("l_extendedprice").sum(), col("l_quantity").mean()).sort("l_extendedprice_sum", descending=True).head(10))
_query("q33_identity", "SELECT * FROM region")(lambda t: t("region").query())
_query("q34_column_scan", "SELECT o_custkey FROM orders GROUP BY o_custkey")(lambda t: t("orders").group_by("o_custkey").agg())


# ---- tables and series


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indices of a text column and its dictionary, in the plan."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_type")
    return coded(part, "p_type").select("p_partkey", "code", F.col("p_type").alias("value"))


def _shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns, names and types of a table, through its accessors."""
    orders = Context(spark).read_parquet(f"{sf_dir}/orders.parquet")
    rows = [(i, name, orders.dtypes[name], orders.n_cols, orders.n_rows) for i, name in enumerate(orders.columns)]
    return spark.createDataFrame(rows, "position int, name string, dtype string, n_cols int, n_rows bigint")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column's raw values, through the table's accessor: regions only, a
    table of fixed size."""
    region = Context(spark).read_parquet(f"{sf_dir}/region.parquet").sort("r_regionkey").collect_sync()
    keys, names = region.col("r_regionkey"), region.col("r_name")
    rows = [(int(k), names.dictionary[int(i)]) for k, i in zip(keys.data, names.indices)]
    schema = T.StructType([T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())])
    return spark.createDataFrame(rows, schema)


def _bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with nulls: its bitmap, bit by bit (nations, a fixed size)."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumn("region", F.expr("nullif(n_regionkey, 0)"))
    found = Context(spark).table(nation).sort("n_nationkey").collect_sync()
    keys, region = found.col("n_nationkey"), found.col("region")
    valid = [bool(region.null_bitmap[i // 8] >> i % 8 & 1) for i in range(len(region))]
    rows = [(int(k), v, int(x)) for k, v, x in zip(keys.data, valid, region.data)]
    return spark.createDataFrame(rows, "n_nationkey int, valid boolean, raw int")


def _csv(table: str, schema: str | None, late: bool):
    """A table written as CSV and read back through the context."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = files.scratch(spark, "csv")
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.options(header=True, escape='"').csv(path)
        context = Context(spark)
        return (context.read_csv_async(path, schema).result() if late else context.read_csv(path, schema)).to_df()

    return run


def _csv_line_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.scratch(spark, "csv")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    noted = part.select("p_partkey", F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", ')).alias("note"))
    noted.write.options(header=True, escape='"', quoteAll=True, ignoreTrailingWhiteSpace=False).csv(path)
    return Context(spark).read_csv(path).to_df()


def _collect_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query run on another thread, then asked for its rows."""
    orders = Context(spark).read_parquet(f"{sf_dir}/orders.parquet")
    pending = orders.filter(col("o_totalprice") > 300_000).group_by("o_orderpriority").agg(col("o_orderkey").count().alias("n")).collect()
    return pending.result().to_df()


_DIRECT: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "q30_dictionary": (_dictionary, "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_type) - 1)::BIGINT AS code, p_type AS value FROM part"),
    "q32_shape": (
        _shape,
        """SELECT position, name, dtype, 6 AS n_cols, (SELECT count(*) FROM orders) AS n_rows FROM (VALUES
        (0, 'o_orderkey', 'i64'), (1, 'o_custkey', 'i64'), (2, 'o_orderstatus', 'sym'), (3, 'o_totalprice', 'f64'),
        (4, 'o_orderdate', 'timestamp'), (5, 'o_orderpriority', 'sym')) AS v(position, name, dtype)""",
    ),
    "q35_series": (_series, "SELECT r_regionkey, r_name FROM region"),
    "q36_csv": (_csv("customer", "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", late=False), "SELECT * FROM customer"),
    "q36_csv_async": (_csv("supplier", None, late=True), "SELECT s_suppkey::INT AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"),
    "q36_csv_line_feeds": (_csv_line_feeds, "SELECT p_partkey::INT AS p_partkey, p_name || chr(10) || '\"' || p_brand || '\", ' AS note FROM part"),
    "q37_null_bitmap": (_bitmap, "SELECT n_nationkey, n_regionkey <> 0 AS valid, n_regionkey AS raw FROM nation"),
    "q38_collect_async": (_collect_async, "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY ALL"),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["q28_flagship"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(build, rounded) for name, (build, _, rounded) in _BUILT.items()} | {name: run for name, (run, _) in _DIRECT.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql, _) in _BUILT.items()} | {name: sql for name, (_, sql) in _DIRECT.items()}
