"""Query registration and the shape in which results are compared."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featuremart.catalogue.roles import ROLES, TABLES
from featuremart.functions.calendar import add_months, month_end
from featuremart.sources.storage import scratch_path
from featuremart.sources.tables import ensure_db

AS_OF = date(2001, 7, 31)
DB = "featuremart_check"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one folder, and the roles derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in ROLES[name]}
            return self.spark.sql(ROLES[name], **used)
        if name in TABLES:
            if name not in self._read:
                self._read[name] = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
            return self._read[name]
        raise AttributeError(name)


def fresh_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A catalog name without a table, and a fresh folder for one."""
    ensure_db(spark, DB, scratch_path(spark, DB))
    spark.sql(f"DROP TABLE IF EXISTS {DB}.{name}")
    return f"{DB}.{name}", scratch_path(spark, name)


def plain(df: DataFrame) -> DataFrame:
    """Only bigint, double and string columns, which all engines render alike."""
    out = []
    for f in df.schema.fields:
        expr = f"`{f.name}`"
        if isinstance(f.dataType, T.IntegralType):
            expr = f"cast({expr} as bigint)"
        elif isinstance(f.dataType, T.FractionalType):
            expr = f"cast({expr} as double)"
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType)):
            expr = f"cast(cast({expr} as date) as string)"
        out.append(f"{expr} as `{f.name}`")
    return df.selectExpr(*out)


def query(name: str, sql: str | None = None, roles: tuple[str, ...] = ()):
    """Register a query; ``roles`` are put before the SQL as common table expressions."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes({r: role_sql(r) for r in roles}, sql)
        return fn

    return register


def role_sql(name: str) -> str:
    return ROLES[name].format(**{t: t for t in TABLES})


def with_ctes(ctes: dict[str, str], body: str) -> str:
    """``body`` preceded by the given queries; ``body`` may start with its own ``with``."""
    if not ctes:
        return body
    head = ", ".join(f"{name} as ({text})" for name, text in ctes.items())
    text = body.strip()
    if text.lower().startswith("with "):
        return f"with {head}, {text[5:]}"
    return f"with {head} {text}"


def day(value: date) -> str:
    return f"date '{value.isoformat()}'"


def moved(sql: str, months: int) -> str:
    """The SQL text for a day ``months`` before ``AS_OF``: its month ends and snapshot days (the 22nd) are moved."""
    days = {f(k): f(k + months) for k in range(12) for f in (lambda k: month_end(AS_OF, k), lambda k: add_months(AS_OF.replace(day=22), -k))}

    def earlier(found: re.Match) -> str:
        value = date.fromisoformat(found[1])
        return day(days.get(value, value))

    return re.sub(r"date '(\d{4}-\d\d-\d\d)'", earlier, sql)


def in_months(col: str, n: int = 5, as_of: date = AS_OF) -> str:
    """SQL test for the ``n``-month window."""
    return f"(cast({col} as date) > {day(month_end(as_of, n))} and cast({col} as date) <= {day(month_end(as_of))})"


def in_month(col: str, k: int, as_of: date = AS_OF) -> str:
    """SQL test for month slot ``k``."""
    return (
        f"(cast({col} as date) > {day(month_end(as_of, k + 1))}"
        f" and cast({col} as date) <= {day(month_end(as_of, k))})"
    )


def casts(kind: str, names) -> str:
    """``cast("a" as kind) as "a", …``"""
    return ", ".join(f'cast("{n}" as {kind}) as "{n}"' for n in names)
