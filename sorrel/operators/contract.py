"""Row contracts of association tables: typed checks in a fixed order, duplicates, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The columns of an association table, in order.
COLUMNS = ("chr", "rs", "pos", "n_miss", "allele1", "allele0", "af", "beta", "se", "logl_H1", "l_remle", "l_mle", "p_wald", "pval", "p_score")
KEY = ("chr", "pos", "allele0", "allele1")
_FLOAT = r"^[\x20\t]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[\x20\t]*$"


class ContractError(ValueError):
    """A table breaks its contract."""


class SchemaError(ContractError):
    pass


class RowError(ContractError):
    pass


class DuplicateError(ContractError):
    pass


class RowCountError(ContractError):
    pass


class ChecksumError(ContractError):
    pass


def check_header(found: list[str], expected: tuple[str, ...] = COLUMNS) -> None:
    if len(set(found)) != len(found):
        raise SchemaError(f"repeated columns: {sorted({c for c in found if found.count(c) > 1})}")
    if tuple(found) != expected:
        raise SchemaError(f"expected the columns {list(expected)}, found {found}")


def integer(column: str) -> Column:
    """Base-10 digits with an optional minus sign, or null."""
    return F.when(F.trim(column).rlike("^-?[0-9]+$"), F.trim(column).try_cast("bigint"))


def finite(column: str) -> Column:
    """A finite decimal number, or null."""
    x = F.when(F.col(column).rlike(_FLOAT), F.trim(column).try_cast("double"))
    return F.when(F.abs(x) < float("inf"), x)


def violation() -> Column:
    """The first rule that a row of text columns breaks, as (column, value, reason), or null."""

    def unless(column: str, ok: Column, reason: str) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(column).alias("column"), F.col(column).alias("value"), F.lit(reason).alias("reason")))

    checks = [unless(c, F.trim(c) != "", "is empty") for c in ("chr", "allele1", "allele0")]
    checks += [unless("pos", integer("pos") > 0, "isn't a positive integer"), unless("n_miss", integer("n_miss") >= 0, "isn't a non-negative integer"), unless("af", finite("af").between(0, 1), "isn't a number from 0 to 1")]
    checks += [unless(c, (finite(c) > 0) & (finite(c) <= 1), "isn't a number above 0, up to 1") for c in ("p_wald", "pval", "p_score")]
    checks += [unless(c, finite(c).isNotNull(), "isn't a finite number") for c in ("beta", "se", "logl_H1", "l_remle", "l_mle")]
    return F.coalesce(*checks, unless("se", finite("se") >= 0, "is negative"))


def violations(rows: DataFrame) -> DataFrame:
    """The broken rule of every row that breaks one: src_row, column, value, reason."""
    return rows.select("src_row", violation().alias("v")).where("v is not null").select("src_row", "v.*")


def first_violations(rows: DataFrame, family: list[str]) -> DataFrame:
    """The first broken row of each family."""
    return rows.select(*family, "src_row", violation().alias("v")).where("v is not null").groupBy(*family).agg(F.min("src_row").alias("src_row"), F.min_by("v", "src_row").alias("v")).select(*family, "src_row", "v.*")


def duplicates(rows: DataFrame, key: list[str], order: str = "src_row") -> DataFrame:
    """Every row whose key an earlier row has, with the first row that has it."""
    w = Window.partitionBy(*key)
    return rows.withColumns({"first_row": F.min(order).over(w)}).where(F.col(order) > F.col("first_row")).select(*key, "first_row", F.col(order).alias("duplicate_row"))


def counts(rows: DataFrame, expected: DataFrame, family: list[str]) -> DataFrame:
    """Rows of each family against the expected n_expected; families of either side alone count as 0."""
    found = rows.groupBy(*family).agg(F.count("*").alias("n_rows"))
    return found.join(expected, family, "full").select(*family, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_expected", F.lit(0)).alias("n_expected")).withColumn("ok", F.col("n_rows") == F.col("n_expected"))


def validate(rows: DataFrame, header: list[str], expected_rows: int | None = None) -> int:
    """Check one table (text columns and src_row, and _corrupt for ragged rows if there is any); returns its row count. The first failure in order is raised: header, then rows (ragged before a field's rule,
    before a repeated key), then the count."""
    check_header(header)
    ragged = F.col("_corrupt").isNotNull() if "_corrupt" in rows.columns else F.lit(False)
    key = F.struct(F.trim("chr").alias("chr"), integer("pos").alias("pos"), F.trim("allele0").alias("allele0"), F.trim("allele1").alias("allele1"))
    judged = rows.select("src_row", ragged.alias("ragged"), violation().alias("v"), key.alias("key"))
    worst = judged.agg(F.count("*").alias("n"), F.min(F.when(F.col("ragged") | F.col("v").isNotNull(), F.struct("src_row", "ragged", "v"))).alias("bad")).first()
    twice = duplicates(judged, ["key"]).agg(F.min(F.struct(F.col("duplicate_row").alias("row"), F.col("first_row").alias("first")))).first()[0]
    if worst.bad is not None and (twice is None or worst.bad.src_row <= twice.row):
        if worst.bad.ragged:
            raise RowError(f"row {worst.bad.src_row} has another number of fields than the header")
        raise RowError(f"row {worst.bad.src_row}, column {worst.bad.v.column}: {worst.bad.v.value!r} {worst.bad.v.reason}")
    if twice is not None:
        raise DuplicateError(f"rows {twice.first} and {twice.row} have the same variant")
    if expected_rows is not None and worst.n != expected_rows:
        raise RowCountError(f"expected {expected_rows} rows, found {worst.n}")
    return worst.n


def p_violations(df: DataFrame, p: str, order: str = "src_row") -> DataFrame:
    """Values that aren't p-values (finite, above 0 and up to 1), with the reason."""
    x = F.col(p)
    reason = F.when(x.isNull(), "is missing").when(F.isnan(x) | (F.abs(x) == float("inf")), "isn't finite").when((x <= 0) | (x > 1), "isn't in (0, 1]")
    return df.select(order, p, reason.alias("reason")).where("reason is not null")


def p_value(p: str) -> Column:
    """The column, or an error where it isn't a p-value: no correction is computed from others."""
    x = F.col(p)
    return F.when((x > 0) & (x <= 1), x).otherwise(F.raise_error(F.concat(F.lit(f"{p} isn't a p-value: "), F.coalesce(x.cast("string"), F.lit("null")))).cast("double"))


def unit_interval(closed: bool = True, **levels: float) -> None:
    """Levels such as alpha must lie in (0, 1], or in (0, 1)."""
    for name, x in levels.items():
        if isinstance(x, bool) or not isinstance(x, (int, float)) or not (0 < x < 1 or (closed and x == 1)):
            raise ContractError(f"{name} must be above 0 and {'up to' if closed else 'below'} 1, not {x!r}")


#: Keys of a partition that one task holds of both sides.
KEYS_A_TASK = 2_000_000


def set_differences(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has, with the side; no rows: the sets are equal. A null equals no key, so it stands for both sides that have one.

    Both sides are grouped by key at once. Keys compress well, so partitions of one size in bytes hold any number of them; they are dealt to as many as hold about `KEYS_A_TASK` rows.
    """
    both = left.select(*key, F.lit(1).alias("_side")).unionByName(right.select(*key, F.lit(2).alias("_side")))
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // KEYS_A_TASK))
    sides = both.repartition(tasks, *key).groupBy(*key).agg(F.bit_or("_side").alias("_side"))
    null = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    names = F.filter(F.array(F.lit("left"), F.lit("right")), lambda x: F.when(x == "left", F.col("_side") != 2).otherwise(F.col("_side") != 1))
    return sides.where((F.col("_side") != 3) | null).select(*key, F.explode(names).alias("side"))


def at_most(rows: DataFrame, most: int, what: str) -> DataFrame:
    """The rows, or an error if there are more than `most`: limits aren't truncations."""
    if rows.limit(most + 1).count() > most:
        raise ContractError(f"more than {most} {what}")
    return rows
