"""From raw files to the wide indicator tables, reading only what is new.

``raw/<source>/*`` holds the files.  A run lists them, leaves out those that
the manifest knows in their present length and time, reads the new ones of a
source in one plan, and stores their rows beside the rows of earlier runs.
Then each table whose inputs have changed is built as a new version, and one
pointer is switched to the versions that are complete.  A source or table that
fails is logged and keeps its last version; the others go on.

    store/manifest/run=<n>         files read by a run
    store/silver/<source>/run=<n>  their rows, with path
    store/gold/<table>/run=<n>     versions of a table
    store/pointer/run=<n>          the versions that count
"""

from __future__ import annotations

import argparse
import hashlib
import logging
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.functions.numbers import to_double, to_int
from comarca.functions.periods import period_of_file
from comarca.operators import headed, reshape
from comarca.operators.tables import fused_header
from comarca.sources import delimited, lattice, manifest, xlsx
from comarca.sources.files import latest_snapshot, list_files
from comarca.sources.manifest import Built
from comarca.sources.sinks import write_parquet

from . import batch, population
from .geo import SOURCES, conform, towns
from .indicators import Span, of_grain, wide_both

log = logging.getLogger(__name__)
PATH = ["path"]
#: Sheets of an enrolment workbook, the preferred first.
ENROLMENT_SHEETS = ("CoberturaMunicipio", "EPSMunicipio", "EPS")
#: Kinds of columns that files spell differently; what does not fit is null.
DECLARED = {
    "anio": "int", "edad": "int", "mun_codigo_ref": "int", "poblacion": "bigint", "puntaje_promedio": "double",
    **{c: "bigint" for c in batch.ENROLMENT_COUNTS}, **{c: "int" for c in batch.WATER_INTS if not c.startswith("codigo")}, **{c: "double" for c in batch.WATER_DOUBLES},
}
#: Registers that state all there is each time: only their last snapshot counts.
REGISTERS = tuple(s for s in SOURCES if s.startswith(("reps_", "supersalud_")))
ANNUAL = ("demografico_edad_sexo", "demografico_etnico")


def _population_names(upper: Sequence[str | None], lower: Sequence[str | None]) -> tuple[list[str], int]:
    """One header row, or two where the lower one holds measures."""
    two = any(str(c).strip().lower().startswith(("hombres", "mujeres")) for c in lower if c)
    names = fused_header(upper, lower if two else [])
    return headed.unique_names([population.RENAMED.get(n, n) or f"_{i}" for i, n in enumerate(names)], fold=True), 1 + two


def _population(melt: Callable[..., DataFrame]) -> Callable[[SparkSession, list[str]], DataFrame]:
    def read(spark: SparkSession, paths: list[str]) -> DataFrame:
        rows = xlsx.read_rows(spark, paths).drop("sheet")
        heads = headed.headers(rows, PATH, headed.holds_any(population.HEADER_KEYS), _population_names, within=25, needed=True)
        return melt(headed.by_name(rows, heads, PATH).drop("row_no"), PATH)

    return read


def _enrolment_names(upper: Sequence[str | None], lower: Sequence[str | None]) -> tuple[list[str], int]:
    names, rows = headed.plain_names(upper, lower)
    return headed.unique_names([batch.ENROLMENT_NAMES.get(n, n) for n in names], fold=True), rows


def _enrolment(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = xlsx.read_rows(spark, paths, ENROLMENT_SHEETS).drop("sheet")
    heads = headed.headers(rows, PATH, headed.filled(3), _enrolment_names, within=10)
    named = headed.by_name(rows, heads, PATH).drop("row_no")
    period = period_of_file(F.regexp_extract("path", "[^/]*$", 0))
    return batch.tidy_enrolment(named, period["year"], period["month"], keep=PATH)


def _water(spark: SparkSession, paths: list[str]) -> DataFrame:
    return batch.tidy_water(reshape.trimmed_names(delimited.read_mixed(spark, paths)), batch.WATER_NAMES)


def _supervision(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = xlsx.read_rows(spark, paths).drop("sheet")
    heads = headed.headers(rows, PATH, headed.filled(3, longer_than=1), headed.ascii_names)
    named = headed.by_name(rows, heads, PATH).drop("row_no")
    return named.dropna(how="all", subset=[c for c in named.columns if c not in PATH])


def _stored(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Tables that another tool has extracted, as Parquet."""
    return lattice.read_drifting(spark, paths, path_col="path")


#: How new files of a source become rows with ``path``; other sources are Parquet.
READERS: dict[str, Callable[[SparkSession, list[str]], DataFrame]] = {
    "demografico_edad_sexo": _population(population.by_sex_and_age),
    "demografico_etnico": _population(population.by_ethnic_group),
    "afiliacion": _enrolment,
    "irca": _water,
    **{s: delimited.read_tolerant_files for s in SOURCES if s.startswith("reps_")},
    **{s: _supervision for s in SOURCES if s.startswith("supersalud_")},
}


def recast(df: DataFrame, declared: dict[str, str] = DECLARED) -> DataFrame:
    """Columns in their declared kinds, whatever the files had."""
    def cast(name: str, kind: str) -> Column:
        return to_double(F.col(name)) if kind == "double" else to_int(F.col(name), kind)

    there = dict(df.dtypes)
    return df.withColumns({c: cast(c, k) for c, k in declared.items() if there.get(c, k) != k})


def read_new(spark: SparkSession, raw: str, store: str, source: str, run: int, known: DataFrame) -> int:
    """Store the rows of a source's new files; gives the number of files."""
    found = manifest.listed(spark, f"{raw}/{source}/*")
    if found is None:
        log.warning("no files: %s", source)
        return 0
    new = manifest.unread(found, known, source)
    files = new.collect()  # the names of one run's new files
    if not files:
        return 0
    rows = READERS.get(source, _stored)(spark, [r.path for r in files])
    write_parquet(rows, f"{store}/silver/{source}/run={run}")
    layout = hashlib.sha256(rows.schema.json().encode()).hexdigest()[:16]
    manifest.record(spark.createDataFrame(files, found.schema), source, layout, store, run)
    return len(files)


def silver(spark: SparkSession, store: str, source: str, known: DataFrame, all_snapshots: bool = False) -> DataFrame | None:
    """Rows of a source's files, each file as it was last read; of a register the last snapshot only."""
    mine = known.where(F.col("source") == source).select("path", "run", "snapshot")
    runs = [r.run for r in mine.select("run").distinct().orderBy("run").collect()]
    rows = lattice.read_drifting(spark, [f"{store}/silver/{source}/run={n}" for n in runs], path_col="_file")
    if rows is None:
        return None
    rows = rows.withColumn("run", F.regexp_extract("_file", r"/run=(\d+)/", 1).cast("int")).drop("_file")
    rows = rows.join(mine, ["path", "run"]).drop("run")
    if source in REGISTERS and not all_snapshots:
        rows = latest_snapshot(rows)
    return recast(rows.drop("path", "snapshot"))


def _made_of(inputs: dict[str, int | None], *more: object) -> str:
    """What a version stands on, as one line to compare."""
    return ",".join([f"{n}={v}" for n, v in sorted(inputs.items())] + [str(m) for m in more])


def build_changed(spark: SparkSession, store: str, run: int, as_of: int, before: dict[str, Built]) -> dict[str, Built]:
    """Tables in their new versions where inputs have changed, in their last ones elsewhere."""
    known = manifest.known(spark, store).persist()
    read = {r.source: r.run for r in known.groupBy("source").agg(F.max("run").alias("run")).collect()}
    now = dict(before)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{store}/gold/{name}/run={now[name].version}")

    def step(name: str, inputs: dict[str, int | None], make: Callable[[], DataFrame], *more: object) -> None:
        made_of = _made_of(inputs, *more)
        if name in now and now[name].made_of == made_of:
            return

        def write() -> Built:
            write_parquet(make(), f"{store}/gold/{name}/run={run}")
            return Built(run, made_of)

        if (built := batch.safely(name, write)) is not None:
            now[name] = built

    people = "demografico_edad_sexo"
    if people in read:
        step("geo_maestro", {people: read[people]}, lambda: towns(silver(spark, store, people, known)))
    if "geo_maestro" not in now:
        log.warning("no towns: nothing can be conformed")
        known.unpersist()
        return now
    place = {"geo_maestro": now["geo_maestro"].version}
    for source in (s for s in SOURCES if s in read):
        step(f"conformed_{source}", {source: read[source], **place}, lambda source=source: conform(silver(spark, store, source, known), SOURCES[source], table("geo_maestro")))
    frames = {s: table(f"conformed_{s}") for s in SOURCES if f"conformed_{s}" in now}
    inputs = {s: now[f"conformed_{s}"].version for s in frames} | place
    step("metricas", inputs, lambda: wide_both(frames, table("geo_maestro"), Span(as_of), lenient=True), f"as_of={as_of}")
    for grain, name in (("town", "metricas_municipio"), ("region", "metricas_departamento")):
        if "metricas" in now:
            step(name, {"metricas": now["metricas"].version}, lambda grain=grain: of_grain(table("metricas"), grain))
    known.unpersist()
    return now


def run_intake(spark: SparkSession, raw: str, store: str, as_of: int, sources: Sequence[str] | None = None) -> dict[str, int]:
    """Read what is new of ``sources`` (all), build what has changed, switch to it; gives the files read of each source."""
    run, before = manifest.next_run(spark, store), manifest.pointer(spark, store)
    known = manifest.known(spark, store)
    counts = {s: batch.safely(s, lambda s=s: read_new(spark, raw, store, s, run, known)) for s in sources or SOURCES}
    after = build_changed(spark, store, run, as_of, before)
    if after != before:
        manifest.switch(spark, store, run, after)
    return {s: n for s, n in counts.items() if n}


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Read new raw files and bring the indicator tables up to date.")
    parser.add_argument("mode", choices=("monthly", "annual", "all"), help="monthly: all but the population; annual: the population")
    parser.add_argument("raw")
    parser.add_argument("store")
    parser.add_argument("--as-of", type=int, default=date.today().year, help="last year of population figures")
    given = parser.parse_args(args)
    sources = {"monthly": [s for s in SOURCES if s not in ANNUAL], "annual": list(ANNUAL), "all": list(SOURCES)}[given.mode]
    print(run_intake(SparkSession.builder.getOrCreate(), given.raw, given.store, given.as_of, sources))


if __name__ == "__main__":
    main()
