"""Is lateness associated with mode, region or order value?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.functions.tails import chi_square_p, student_p
from punctual.plans.diagnose import summary
from punctual.plans.estimability import check_estimable
from punctual.sources.warehouse import Warehouse

LABEL = "late_delivery_risk"


def named_orders(house: Warehouse) -> DataFrame:
    """Orders with region, market, mode, value and promise, at order grain.

    Orders without a known place or mode are left out, as the inner joins of the
    published queries do.
    """
    places = house.table("dim_geography").select("geography_id", "order_region", "market")
    return (
        house.table("order_grain").filter("order_id is not null")
        .join(places, "geography_id")
        .join(house.table("dim_shipping_mode"), "shipping_mode_id")
    )


def order_features(house: Warehouse) -> DataFrame:
    """Input of the tests."""
    return named_orders(house).select(
        "order_id", LABEL, "order_region", "shipping_mode", "total_sales"
    )


def contingency(rows: DataFrame, variable: str, label: str = LABEL) -> DataFrame:
    """Counts by variable and label in long form; cells without rows are absent."""
    known = rows.filter(F.col(variable).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(
        F.col(variable).cast("string").alias("row_value"),
        F.col(label).cast("string").alias("column_value"),
    ).agg(F.count("*").alias("n"))


def chi_square_of(table: DataFrame) -> DataFrame:
    """Pearson statistic and p-value of a long contingency table.

    The table is not filled up with zero cells: a zero cell contributes its expected
    count, and expected counts add up to the total, so what the present cells miss is
    added at the end. With one degree of freedom Yates' correction applies; there
    all four cells are equally far from expectation.
    """
    by_row = Window.partitionBy("row_value")
    columns = table.groupBy("column_value").agg(F.sum("n").alias("column_total"))
    total = table.agg(F.sum("n").cast("double"))
    cells = (
        table.withColumn("row_total", F.sum("n").over(by_row))
        .withColumn("row_cells", F.count("*").over(by_row))
        .join(columns, "column_value")
        .withColumn("total", total.scalar())
    )
    expected = F.col("row_total") * F.col("column_total") / F.col("total")
    gap = F.abs(F.col("n") - expected)
    sums = cells.withColumn("expected", expected).withColumn("gap", gap).agg(
        F.sum(F.col("gap") * F.col("gap") / F.col("expected")).alias("present"),
        F.sum("expected").alias("covered"),
        F.max("total").alias("total"),
        F.max("gap").alias("gap"),
        # One row contributes 1 in total, however many cells it has.
        F.round(F.sum(1.0 / F.col("row_cells"))).cast("bigint").alias("n_rows"),
        F.sum(1.0 / F.col("row_cells") / F.col("row_total")).alias("inverse_rows"),
    )
    margins = columns.agg(
        F.count("*").alias("n_columns"),
        F.sum(1.0 / F.col("column_total")).alias("inverse_columns"),
    )
    both = sums.select(
        "*",
        margins.select("n_columns").scalar().alias("n_columns"),
        margins.select("inverse_columns").scalar().alias("inverse_columns"),
    )
    dof = (F.col("n_rows") - 1) * (F.col("n_columns") - 1)
    missing = F.greatest(F.col("total") - F.col("covered"), F.lit(0.0))
    pearson = F.col("present") + missing
    moved = F.col("gap") - F.least(F.lit(0.5), F.col("gap"))
    yates = moved * moved * F.col("total") * F.col("inverse_rows") * F.col("inverse_columns")
    statistic = F.when(dof == 1, yates).when(dof == 0, 0.0).otherwise(pearson)
    tested = both.select(
        statistic.alias("chi2"), dof.alias("dof"), F.col("total").cast("bigint").alias("n_orders")
    )
    return tested.withColumn("p_value", chi_square_p("chi2", F.col("dof").cast("double")))


def chi_square(rows: DataFrame, variable: str, label: str = LABEL) -> DataFrame:
    """Test of independence of ``variable`` and the late flag."""
    result = chi_square_of(contingency(rows, variable, label))
    return result.select(F.lit(variable).alias("variable"), "*")


def chi_square_of_orders(house: Warehouse, variable: str) -> DataFrame:
    """The test for ``variable``, of the place or the mode, and the orders' late flag, from
    the summary of orders; the same orders count as in ``order_features``."""
    keys = ["geography_id", "shipping_mode_id"]
    counted = summary(house, "place_mode").filter("has_order").groupBy(*keys, LABEL).agg(
        F.sum("n").alias("n")
    )
    named = counted.join(house.table("dim_geography"), keys[0]).join(
        house.table("dim_shipping_mode"), keys[1]
    ).filter(F.col(variable).isNotNull() & F.col(LABEL).isNotNull())
    table = named.groupBy(
        F.col(variable).cast("string").alias("row_value"),
        F.col(LABEL).cast("string").alias("column_value"),
    ).agg(F.sum("n").alias("n"))
    return chi_square_of(table).select(F.lit(variable).alias("variable"), "*")


def welch(rows: DataFrame, value: str = "total_sales", label: str = LABEL) -> DataFrame:
    """Two-sample t-test without equal variances, late against on time."""
    number = F.col(value).cast("double")

    def part(flag: int, name: str) -> list:
        chosen = F.when(F.col(label) == flag, number)
        return [
            F.count(chosen).alias(f"n_{name}"),
            F.avg(chosen).alias(f"mean_{name}"),
            F.var_samp(chosen).alias(f"var_{name}"),
        ]

    one = rows.agg(*part(1, "late"), *part(0, "on_time"))
    a = F.col("var_late") / F.col("n_late")
    b = F.col("var_on_time") / F.col("n_on_time")
    freedom = F.try_divide(
        (a + b) * (a + b),
        a * a / (F.col("n_late") - 1) + b * b / (F.col("n_on_time") - 1),
    )
    enough = (F.col("n_late") > 1) & (F.col("n_on_time") > 1)
    tested = one.select(
        "n_late", "n_on_time", "mean_late", "mean_on_time",
        F.when(enough, F.try_divide(F.col("mean_late") - F.col("mean_on_time"),
                                    F.sqrt(a + b))).alias("t"),
        F.when(enough, freedom).alias("dof"),
    )
    return tested.withColumn("p_value", student_p("t", "dof"))


LOGIT_SCHEMA = T.StructType([
    T.StructField("term", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in [
        "coefficient", "std_error", "z", "p_value", "ci_low", "ci_high",
        "log_likelihood", "null_log_likelihood", "pseudo_r2", "aic",
    ]],
])


def logit(
    rows: DataFrame,
    categorical: Sequence[str] = ("shipping_mode", "order_region"),
    numeric: Sequence[str] = ("total_sales",),
    label: str = LABEL,
) -> DataFrame:
    """Unregularized logit, one row per term.

    Treatment coding with the alphabetically first level as base. The fit is
    distributed; its summary, one entry per term, is all the driver handles. Data that do
    not determine the coefficients are an error that names the terms.
    """
    used = rows.select(label, *categorical, *[F.col(c).cast("double") for c in numeric])
    regression = GeneralizedLinearRegression(family="binomial", link="logit")
    clean = used.dropna().persist()
    try:
        # A factor with one level is part of the intercept.
        levels = clean.agg(*[(F.min(c) != F.max(c)).alias(c) for c in categorical]).first()
        factors = [c for c in categorical if levels[c]]
        check_estimable(clean, factors, numeric, label)
        formula = RFormula(
            formula=f"{label} ~ {' + '.join([*factors, *numeric])}",
            stringIndexerOrderType="alphabetDesc",
        )
        fitted = Pipeline(stages=[formula, regression]).fit(clean)
        encoded = fitted.stages[0].transform(clean)
        model = fitted.stages[1]
        summary = model.summary
        attributes = encoded.schema["features"].metadata["ml_attr"]["attrs"]
        names = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
        terms = [names[i] for i in range(len(names))] + ["Intercept"]
        values = [*model.coefficients.toArray().tolist(), model.intercept]
        fit = (
            -summary.deviance / 2, -summary.nullDeviance / 2,
            1 - summary.deviance / summary.nullDeviance, summary.aic,
        )
        table = [
            (term, beta, se, z, p, beta - 1.959963984540054 * se,
             beta + 1.959963984540054 * se, *fit)
            for term, beta, se, z, p in zip(
                terms, values, summary.coefficientStandardErrors,
                summary.tValues, summary.pValues,
            )
        ]
    finally:
        clean.unpersist()
    return rows.sparkSession.createDataFrame(table, LOGIT_SCHEMA)
