"""Provider registers: institutions by legal nature per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions.numbers import to_int
from comarca.functions.text import collapse_blanks, contains_or_code, legal_nature, title_case
from comarca.operators.aggregate import crosstab

NATURES = ["Pública", "Privada", "Mixta"]


def institutions(register: DataFrame) -> DataFrame:
    """Cleaned rows of institutions: code 1, or named as one."""
    texts = {c: collapse_blanks(F.col(c)) for c in ("depa_nombre", "muni_nombre", "clpr_nombre", "naju_nombre") if c in register.columns}
    clean = register.withColumns(texts)
    clean = clean.withColumns({c: title_case(F.col(c)) for c in ("depa_nombre", "muni_nombre") if c in clean.columns})
    code = to_int(F.col("clpr_codigo")) if "clpr_codigo" in clean.columns else F.lit(None).cast("int")
    name = F.col("clpr_nombre") if "clpr_nombre" in clean.columns else F.lit(None).cast("string")
    return clean.withColumn("clpr_codigo", code).where(contains_or_code(name, "IPS", F.col("clpr_codigo"), 1))


def summary(register: DataFrame) -> DataFrame:
    """(depa_nombre, Pública, Privada, Mixta, Total_IPS), most first; other natures are not counted."""
    natured = institutions(register).withColumn("naju_nombre", legal_nature(F.col("naju_nombre")))
    return crosstab(natured.where(F.col("naju_nombre").isNotNull() & F.col("depa_nombre").isNotNull()), "depa_nombre", "naju_nombre", NATURES, "Total_IPS")
