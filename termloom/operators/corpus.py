"""Corpora as tables: stages and their runner, versions, resumption, repositories and views.

A corpus is a folder of Parquet tables, one for each stage's version, and a table of runs. A stage takes the documents that
its input has and its output lacks, so a run that was killed is continued by running again, whatever it left behind.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import __version__
from termloom.functions import tagging
from termloom.operators import segmenting
from termloom.operators import sentences as S
from termloom.runtime import exists, sorted_side
from termloom.sources import manifests, readers, sinks

STAGES = {
    "en": ("populate", "xml2txt", "txt2tag", "tag2chk"),
    "cn": ("populate", "xml2txt", "txt2seg", "seg2tag", "tag2chk"),
}
STAGES["de"] = STAGES["en"]


@dataclass(frozen=True)
class Step:
    """A stage and its options."""

    stage: str
    options: tuple[tuple[str, str], ...] = ()


def parse_pipeline(lines: list[str]) -> list[Step]:
    """Lines ``stage --name=value --flag``; a bare flag is True, blanks and comments are skipped."""
    out = []
    for line in lines:
        stage, *options = line.partition("#")[0].split() or [""]
        if stage:
            pairs = (o.lstrip("-").partition("=") for o in options)
            out.append(Step(stage, tuple((k, v if sep else "True") for k, sep, v in pairs)))
    return out


def parse_settings(lines: list[str]) -> dict[str, str]:
    """Lines ``key = value``; lines that begin with $ or # are skipped."""
    kept = (line for line in lines if line.strip() and line[0] not in "$#")
    return {k.strip(): v.strip() for k, _, v in (line.partition("=") for line in kept)}


@dataclass
class Version:
    """A stage's output: its number, the steps that made it, how many documents it has."""

    stage: str
    version: str
    trace: tuple[Step, ...]
    processed: int = 0


@dataclass
class Registry:
    """Which stage outputs exist; the driver's bookkeeping, a row per version."""

    versions: list[Version] = field(default_factory=list)

    def resolve(self, pipeline: list[Step], stage: str, create: bool = False) -> Version:
        """The version made by exactly the pipeline's steps up to ``stage``; a new number if there is none and one may be made."""
        names = [s.stage for s in pipeline]
        if stage not in names:
            raise ValueError(f"stage {stage!r} is not in the pipeline")
        trace = tuple(pipeline[: names.index(stage) + 1])
        found = [v for v in self.versions if v.stage == stage and v.trace == trace]
        if len(found) > 1:
            raise ValueError(f"several versions of {stage!r} have the same steps")
        if found:
            return found[0]
        if not create:
            raise LookupError(f"no version of {stage!r} for these steps")
        number = 1 + max((int(v.version) for v in self.versions if v.stage == stage), default=0)
        made = Version(stage, f"{number:02d}", trace)
        self.versions.append(made)
        return made

    def advance(self, pipeline: list[Step], stage: str, limit: int) -> Version:
        """Count ``limit`` more documents of ``stage``; its input must have as many."""
        names = [s.stage for s in pipeline]
        at = names.index(stage)
        out = self.resolve(pipeline, stage, create=True)
        if at and self.resolve(pipeline, names[at - 1]).processed < out.processed + limit:
            raise ValueError(f"{names[at - 1]!r} has too few documents for {limit} more of {stage!r}")
        out.processed += limit
        return out


RUNS = "stage string, version string, options string, trace string, engine string, limit long, at timestamp, seconds double"
#: A repository's tables by its type, empty.
REPOSITORIES = {
    "patents": {"ids": "doc_id string, prefix string, kind string, path string", "files": "path string, size long", "dates": "doc_id string, added timestamp"},
    "articles": {"ids": "doc_id string, path string", "files": "path string, size long", "dates": "doc_id string, added timestamp"},
}


def create_repository(spark: SparkSession, path: str, kind: str) -> None:
    """The tables of a new repository of a known kind; one that is there already is an error."""
    if kind not in REPOSITORIES:
        raise ValueError(f"unknown repository type {kind!r}; known: {sorted(REPOSITORIES)}")
    for name, schema in REPOSITORIES[kind].items():
        sinks.create(spark.createDataFrame([], schema), f"{path}/{name}")


def open_repository(spark: SparkSession, path: str, kind: str) -> dict[str, DataFrame]:
    """The tables of a repository."""
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in REPOSITORIES[kind].items()}


@dataclass
class Corpus:
    """A corpus at ``path``: its manifest (line_no, year, source, target), language, data source, and pipeline.

    ``files`` gives the content (path, content) of the manifest's sources; ``tagger`` and ``segmenter`` start a provider once a
    partition (without a tagger English and German text goes to the rules).
    """

    spark: SparkSession
    path: str
    manifest: DataFrame
    files: DataFrame
    source: str = "ln"
    language: str = "en"
    pipeline: list[Step] | None = None
    tagger: Callable | None = None
    segmenter: Callable | None = None

    def __post_init__(self):
        if self.language not in STAGES:
            raise ValueError(f"unknown language {self.language!r}; known: {sorted(STAGES)}")
        self.pipeline = self.pipeline or [Step(s) for s in STAGES[self.language]]

    # --- bookkeeping

    def trace(self, stage: str) -> tuple[Step, ...]:
        names = [s.stage for s in self.pipeline]
        if stage not in names:
            raise ValueError(f"stage {stage!r} is not in the pipeline")
        return tuple(self.pipeline[: names.index(stage) + 1])

    def version(self, stage: str) -> str:
        """Names what the steps up to the stage make of the source in the language: other options, another version."""
        said = json.dumps([self.source, self.language, [(s.stage, s.options) for s in self.trace(stage)]])
        return hashlib.sha256(said.encode()).hexdigest()[:12]

    def table(self, stage: str) -> DataFrame | None:
        """A stage's output, None before its first run."""
        at = f"{self.path}/{stage}/{self.version(stage)}"
        return self.spark.read.parquet(at) if exists(self.spark, at) else None

    def runs(self) -> DataFrame:
        at = f"{self.path}/runs"
        return self.spark.read.schema(RUNS).parquet(at) if exists(self.spark, at) else self.spark.createDataFrame([], RUNS)

    # --- stages: documents of the input, one row each, to rows with their line_no

    def _populate(self, todo: DataFrame, options: dict) -> DataFrame:
        return manifests.populate(todo, self.files).select("line_no", "year", "target", F.col("source").alias("path"), F.col("content").cast("string").alias("content"), "missing")

    def _xml2txt(self, todo: DataFrame, options: dict) -> DataFrame:
        docs = todo.where("NOT missing").select(F.col("line_no").alias("doc_id"), "path", "content")
        own = {"language": self.language, "match": options.get("match", "exact")} if self.source == "ln" else {}
        fields = readers.read(self.source, docs, **own)
        text = readers.render_fielded(fields).select(F.col("doc_id").cast("long").alias("line_no"), "text")
        errors = fields.where("error IS NOT NULL").select(F.col("doc_id").cast("long").alias("line_no"), "error")
        # every document has a row, an empty one if it failed or its file is missing
        return todo.select("line_no", "target").join(sorted_side(text), "line_no", "left").join(sorted_side(errors), "line_no", "left").withColumn("text", F.coalesce("text", F.lit("")))

    def _lines(self, todo: DataFrame) -> DataFrame:
        """The lines of texts that an earlier stage has cleaned."""
        return todo.select(F.col("line_no").alias("doc_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))

    def _txt2seg(self, todo: DataFrame, options: dict) -> DataFrame:
        if self.segmenter is None:
            raise ValueError("Chinese text needs a segmenter")
        lines = segmenting.segmented(segmenting.gathered(self._lines(todo)), self.segmenter)
        return self._joined(todo, lines, F.struct("line_no", "part"), "line")

    def _tag(self, todo: DataFrame, options: dict) -> DataFrame:
        lines = S.lines_of(todo.withColumnRenamed("line_no", "doc_id")) if self.language != "cn" else self._lines(todo)
        if self.tagger is not None:
            tagged = tagging.tag_lines(lines.where("line <> 'END'"), self.language, self.tagger).where("tagged IS NOT NULL")
            return self._joined(todo, tagged, F.struct("line_no", F.lit(0)), "tagged")
        if self.language == "cn":
            raise ValueError("Chinese text needs a tagger")
        heads = lines.where("line LIKE 'FH\\_%'").select("doc_id", "line_no", F.lit(-1).alias("part"), "line")
        cut = lines.where("line NOT LIKE 'FH\\_%' AND line <> 'END'").select("doc_id", "line_no", F.posexplode(tagging.split_sentences(F.col("line"))).alias("part", "line"))
        toks = tagging.tagged(tagging.split_tokens(F.col("line")))
        said = F.array_join(F.transform(toks, lambda t: F.concat_ws("_", t["tok"], t["tag"])), " ")
        rows = heads.union(cut.withColumn("line", said)).where("line <> ''")
        return self._joined(todo, rows, F.struct("line_no", "part"), "line")

    def _joined(self, todo: DataFrame, lines: DataFrame, order, line: str) -> DataFrame:
        """Documents with their lines as one text."""
        listed = lines.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(order.alias("at"), F.col(line).alias("line")))).alias("l"))
        text = listed.select(F.col("doc_id").alias("line_no"), F.array_join(F.col("l.line"), "\n").alias("text"))
        return todo.select("line_no", "target").join(sorted_side(text), "line_no", "left").withColumn("text", F.coalesce("text", F.lit("")))

    def _tag2chk(self, todo: DataFrame, options: dict) -> DataFrame:
        sections = S.sections_of(self._lines(todo))
        sents = S.sentences_of(sections, pretagged=True)
        wanted = options.get("candidate-filter", "off") == "on"
        schema = options.get("chunker-rules", tagging.chunker_for(self.language))
        dated = sections.where("section = 'DATE'").withColumn("line", F.regexp_replace("line", "_[^_ ]*( |$)", "$1"))
        years = S.years_of(dated)
        sents = S.title_nouns(sents) if wanted else sents
        rows = S.feature_rows(S.chunks_of(S.with_verbs(sents) if self.language == "en" else sents, schema), self.language)
        slim = rows.select("doc_id", "sent_id", "cs", "section", "term", "features", *(["lead_nouns"] if wanted else []))
        terms = S.candidates(slim, wanted).join(sorted_side(years), "doc_id", "left")
        made = terms.select(F.col("doc_id").alias("line_no"), F.struct("uid", F.coalesce("year", F.lit("9999")).alias("year"), "term", "features").alias("t"))
        lists = made.groupBy("line_no").agg(F.collect_list("t").alias("terms"))
        return todo.select("line_no", "target").join(sorted_side(lists), "line_no", "left").withColumn("terms", F.coalesce("terms", F.array().cast(lists.schema["terms"].dataType)))

    STAGE = {"populate": "_populate", "xml2txt": "_xml2txt", "txt2tag": "_tag", "txt2seg": "_txt2seg", "seg2tag": "_tag", "tag2chk": "_tag2chk"}

    # --- running

    def run_stage(self, stage: str, limit: int | None = None) -> int:
        """Process the next documents of a stage, all or ``limit``, append them and record the run; the number of documents done."""
        trace = self.trace(stage)
        options = dict(trace[-1].options)
        inputs = self.manifest if len(trace) == 1 else self.table(trace[-2].stage)
        if inputs is None:
            raise LookupError(f"{trace[-2].stage!r} has no documents for {stage!r}")
        done = self.table(stage)
        todo = pending(inputs, done, "line_no") if done is not None else inputs
        if limit is not None:
            if len(trace) > 1 and todo.count() < limit:
                raise ValueError(f"{trace[-2].stage!r} has too few documents for {limit} more of {stage!r}")
            todo = todo.orderBy("line_no").limit(limit)
        begun, at = time.perf_counter(), datetime.datetime.now()
        n = todo.count()
        if n:
            made = getattr(self, self.STAGE[stage])(todo, options)
            made.write.mode("append").parquet(f"{self.path}/{stage}/{self.version(stage)}")
        seconds = time.perf_counter() - begun
        row = (stage, self.version(stage), json.dumps(options, sort_keys=True), json.dumps([(s.stage, s.options) for s in trace]), __version__, n, at, seconds)
        self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(f"{self.path}/runs")
        return n

    def run(self, limit: int | None = None) -> DataFrame:
        """All stages in order; the feature rows (line_no, target, uid, year, term, features)."""
        for step in self.pipeline:
            self.run_stage(step.stage, limit)
        return self.features()

    def features(self) -> DataFrame:
        rows = self.table(self.pipeline[-1].stage)
        return rows.select("line_no", "target", F.explode("terms").alias("t")).select("line_no", "target", "t.*")


def pending(inputs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inputs of a stage that its output lacks: reruns append what is missing, whatever was lost."""
    return inputs.join(sorted_side(done.select(key)), key, "left_anti")


def processing_time(runs: DataFrame) -> DataFrame:
    """Runs (stage, limit, at, seconds) by stage: count, seconds in all and per document, the first run's time."""
    return runs.groupBy("stage").agg(
        F.count("*").alias("runs"),
        F.round(F.sum("seconds"), 4).alias("seconds"),
        F.round(F.sum("seconds") / F.sum("limit"), 4).alias("per_doc"),
        F.date_format(F.min("at"), "yyyy:MM:dd-HH:mm:ss").alias("first_run"),
    )


def earliest_options(runs: DataFrame) -> DataFrame:
    """Per stage the engine version and options of its first run."""
    return runs.groupBy("stage").agg(F.min_by("version", "at").alias("version"), F.min_by("options", "at").alias("options"))


def add_to_repository(repository: DataFrame, batch: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``batch`` to append: unknown keys, the first of each."""
    return batch.join(sorted_side(repository.select(key)), key, "left_anti").dropDuplicates([key])


def repository_size(files: DataFrame) -> DataFrame:
    return files.agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.expr("sum(size) div 1000000").alias("megabytes"))


def view(ids: DataFrame, repository: DataFrame, key: str = "doc_id") -> DataFrame:
    """Listed ids with their path, null where the repository has none."""
    return ids.join(sorted_side(repository), key, "left")


def view_coverage(ids: DataFrame, present: DataFrame, key: str = "doc_id") -> DataFrame:
    """How many listed ids are present and missing."""
    met = ids.join(present.select(key).distinct().withColumn("_there", F.lit(1)), key, "left")
    return met.agg(F.count("*").alias("listed"), F.count("_there").alias("present"), (F.count("*") - F.count("_there")).alias("missing"))
