"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import balanced


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


QUERIES: dict[str, Query] = {}


def query(operators: str, sql: str | None = None):

    def add(build):
        QUERIES[build.__name__] = Query(build, sql, operators)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts get heavy per-row work (regex passes, tokenizing, models)."""
    return balanced(table(spark, sf_dir, name))


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


PIECE_SQL = r"\s*(?:[\p{L}\p{N}]+|[^\p{L}\p{N}\s])(?:\s+\z)?|\s+"
TOKEN_SQL = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def n_tokens_sql(expression: str, cap: int | None = None) -> str:
    n = f"len(regexp_extract_all({expression}, '{TOKEN_SQL}'))"
    return f"least({n}, {cap})" if cap else n


def strip_sql(expression: str) -> str:
    ws = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
    return f"regexp_replace({expression}, '^{ws}+|{ws}+$', '', 'g')"


def summary_sql(expression: str) -> str:
    """What the stand-in generator answers."""
    words = f"len(regexp_extract_all({expression}, '[A-Za-z]+'))"
    return f"({words}::VARCHAR || ' words, digest ' || substr(md5({expression}), 1, 8) || '.')"


def embedding_sql(source: str, name: str = "v", salt: str = "") -> str:
    """CTEs giving ``{name}(id, dim, val)`` and ``{name}_norm(id, n2)`` of the stand-in embedder."""
    return f"""{name}_w AS (SELECT id, unnest(regexp_extract_all(text, '[A-Za-z]+')) AS w FROM {source}),
    {name}_h AS (SELECT id, ('0x' || substr(md5({quoted(salt)} || w), 1, 8))::UBIGINT AS h FROM {name}_w),
    {name} AS (SELECT id, h % 64 AS dim, sum(CASE WHEN (h // 64) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS val
               FROM {name}_h GROUP BY 1, 2),
    {name}_norm AS (SELECT id, sum(val * val) AS n2 FROM {name} GROUP BY 1)"""
