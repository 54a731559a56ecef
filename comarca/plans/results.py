"""Answers of the serving queries, stored under the versions of the tables they read.

    store/results/<question>/of=<tables>/with=<arguments>/attempt=<id>

``of`` names the versions (from the pointer) of the tables that a question
reads, ``with`` its arguments.  An answer is found again while those tables
stay as they are, however long; once one has a new version the question misses,
and :func:`expire` clears what no kept pointer leads to.  An attempt counts
once its success mark is there, so a writer that dies leaves nothing that is
read, and two writers of an answer do not meet.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from comarca.sources import manifest
from comarca.sources.files import delete, list_files
from comarca.sources.manifest import Built
from comarca.sources.sinks import write_parquet

from . import serving
from .geo import SOURCES
from .indicators import GROUPS, Frames

Pointer = Mapping[str, Built]


@dataclass(frozen=True)
class Tables:
    """The current tables: conformed sources by name, and others of the store."""

    spark: SparkSession
    store: str
    pointer: Pointer

    def table(self, name: str) -> DataFrame | None:
        built = self.pointer.get(name)
        return None if built is None else self.spark.read.parquet(f"{self.store}/gold/{name}/run={built.version}")

    def needed(self, name: str) -> DataFrame:
        if (found := self.table(name)) is None:
            raise LookupError(f"no table {name} in {self.store}")
        return found

    def frames(self, names: tuple[str, ...]) -> Frames:
        found = {n: self.table(f"conformed_{n}") for n in names}
        return {n: f for n, f in found.items() if f is not None}


@dataclass(frozen=True)
class Question:
    """What is asked: the answer, and the conformed sources and other tables it reads."""

    answer: Callable[..., DataFrame]
    sources: tuple[str, ...] = ()
    tables: tuple[str, ...] = ()

    def reads(self) -> list[str]:
        return sorted([*(f"conformed_{s}" for s in self.sources), *self.tables])


_OVERLAID = {grain: tuple(g.source for g in GROUPS if grain in g.overlaid) for grain in ("town", "region")}


def _regions(t: Tables, as_of: int, year: int | None = None, month: str | None = None) -> DataFrame:
    frames = t.frames(_OVERLAID["region"]) if year is not None else {}
    return serving.region_metrics(frames, t.needed("geo_maestro"), as_of, year, month, t.needed("metricas_departamento"))


def _towns(t: Tables, as_of: int, region: int | None = None, year: int | None = None, month: str | None = None) -> DataFrame:
    frames = t.frames(_OVERLAID["town"]) if year is not None else {}
    return serving.town_metrics(frames, t.needed("geo_maestro"), as_of, region, year, month, t.needed("metricas_municipio"))


def _report(t: Tables, as_of: int, region: int, town: int | None = None, year: int | None = None, month: str | None = None) -> DataFrame:
    row = None if town is None else _towns(t, as_of, region, year, month).where(f"geo_mun_codigo = {int(town)}")
    return serving.report(t.spark, _regions(t, as_of, year, month), region, row)


_CARDS = ("dift18_departamento", "dift18_municipio")
#: What can be asked, by name.
QUESTIONS: dict[str, Question] = {
    "years": Question(lambda t: serving.available_years(t.frames(serving.YEAR_SOURCES)), serving.YEAR_SOURCES),
    "months": Question(lambda t, year: serving.available_months(t.frames(("afiliacion",)), year), ("afiliacion",)),
    "periods": Question(lambda t, as_of: serving.source_periods(t.spark, t.frames(tuple(SOURCES)), as_of), (*serving.MONTHLY, *serving.PERIODIC, "demografico_edad_sexo", "reps_prestadores")),
    "regions": Question(_regions, _OVERLAID["region"], ("geo_maestro", "metricas_departamento")),
    "towns": Question(_towns, _OVERLAID["town"], ("geo_maestro", "metricas_municipio")),
    "report": Question(_report, tuple(sorted({*_OVERLAID["town"], *_OVERLAID["region"]})), ("geo_maestro", "metricas_departamento", "metricas_municipio")),
    "scorecard": Question(lambda t, town, region: serving.scorecard(t.frames(_CARDS), town, region), _CARDS),
}


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:24]


def _versions(question: Question, pointer: Pointer) -> str:
    """Folder name of the versions that a question reads now."""
    return "of=" + _digest({n: pointer[n].version for n in question.reads() if n in pointer})


def _stored(spark: SparkSession, folder: str) -> str | None:
    """The first complete attempt under an answer's folder."""
    done = sorted(p for p, _ in list_files(spark, f"{folder}/attempt=*/_SUCCESS"))
    return done[0].rsplit("/", 1)[0] if done else None


def ask(spark: SparkSession, store: str, question: str, **arguments: object) -> DataFrame:
    """The answer by the current tables, from its stored copy where there is one.

    A hit reads the stored answer alone.  A miss computes it, stores it and
    reads it back.  Rows come in the order that the serving query gives them.
    """
    asked, pointer = QUESTIONS[question], manifest.pointer(spark, store)
    given = {k: v for k, v in arguments.items() if v is not None}
    folder = f"{store}/results/{question}/{_versions(asked, pointer)}/with={_digest(given)}"
    if (found := _stored(spark, folder)) is None:
        # one file keeps the order; an answer is a table of places, periods or labels
        write_parquet(asked.answer(Tables(spark, store, pointer), **given).coalesce(1), f"{folder}/attempt={uuid.uuid4().hex}")
        found = _stored(spark, folder)
    return spark.read.parquet(found)


def expire(spark: SparkSession, store: str, keep: Sequence[Pointer] = ()) -> int:
    """Delete answers that neither the current pointer nor one of ``keep`` leads to; gives how many versions went."""
    pointers = [manifest.pointer(spark, store), *keep]
    gone = 0
    for name, question in QUESTIONS.items():
        wanted = {_versions(question, p) for p in pointers}
        for path, _ in list_files(spark, f"{store}/results/{name}/of=*"):
            if path.rstrip("/").rsplit("/", 1)[1] not in wanted:
                delete(spark, path)
                gone += 1
    return gone
