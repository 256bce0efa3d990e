"""The corpus pipeline as stages with a manifest: prep, split, embed, align, export."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import plugins
from ..functions import text as T
from ..operators import align, export, ids, pages, split
from ..sources import files
from ..sources.files import stash

ORDER = ("prep", "split", "embed", "align", "export")


@dataclass(frozen=True)
class CorpusConfig:
    """Knobs of a run; ``from_env`` reads the upper-case names with prefix CORPUS_."""

    out: str = "corpus-out"
    subset: int = 0
    subset_offset: int = 0
    dpi: int = 300
    aligner: str = "monotone"
    min_score: float = 0.5
    max_pair_chars: int = 2000
    embed_dim: int = 256
    segment_rows: int = 400
    ocr_backend: str = "none"
    correct: bool = False
    is_split: bool = False
    run_id: str = ""
    extra: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> CorpusConfig:
        made = cls()
        for name, kind in (("out", str), ("subset", int), ("subset_offset", int), ("dpi", int), ("aligner", str), ("min_score", float), ("max_pair_chars", int), ("embed_dim", int), ("segment_rows", int), ("ocr_backend", str), ("run_id", str)):
            if (value := env.get(f"CORPUS_{name.upper()}")) not in (None, ""):
                made = replace(made, **{name: kind(value)})
        for name in ("correct", "is_split"):
            if env.get(f"CORPUS_{name.upper()}", "") not in ("", "0"):
                made = replace(made, **{name: True})
        if made.ocr_backend not in ("none", "images", "documents"):
            raise ValueError(f"unknown OCR backend {made.ocr_backend}")
        if made.aligner not in ("monotone", "twopass"):
            raise ValueError(f"unknown aligner {made.aligner}")
        return made

    @property
    def base(self) -> str:
        sub = f"_sub{self.subset}" + (f"_off{self.subset_offset}" if self.subset_offset else "") if self.subset else ""
        return f"{self.out}{sub}" + (f"/run={self.run_id}" if self.run_id else "")


class Manifest:
    """Which stages are done, in one small JSON file a stage beside the outputs."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def _at(self, stage: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/_stages/{stage}.json")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def done(self, stage: str) -> bool:
        path, fs = self._at(stage)
        return fs.exists(path)

    def mark(self, stage: str, **facts) -> None:
        path, fs = self._at(stage)
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(facts).encode()))
        out.close()

    def snapshot(self, suffix: str, names: tuple[str, ...] = ORDER, dry_run: bool = False) -> list[str]:
        """Rename finished outputs to ``name`` + ``suffix`` and forget their stages, so that another run does not collide.
        Missing outputs and taken names are left alone, so it may run again.  Says what it did, or would do."""
        said = []
        for name in names:
            a, b = (self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}{x}") for x in ("", suffix))
            fs = a.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if not fs.exists(a):
                said.append(f"missing: {name}")
            elif fs.exists(b):
                said.append(f"taken: {name}{suffix}")
            else:
                said.append(f"{name} -> {name}{suffix}")
                if not dry_run:
                    fs.rename(a, b)
                    at, fs = self._at(name)
                    fs.delete(at, False)
        return said

    def clear_from(self, stage: str) -> None:
        """Forget a stage and all after it, as when its inputs are swapped."""
        for name in ORDER[ORDER.index(stage) :]:
            path, fs = self._at(name)
            fs.delete(path, False)


def ocr(scans: DataFrame, config: CorpusConfig, engines, renderer=None, count=None, corrector=None) -> tuple[DataFrame, DataFrame]:
    """Recognised pages (volume, page, text, failed) and failed ones (volume, page, error) of (volume, page, content) images, or
    of (volume, content) documents that ``renderer`` draws first, by the configured backend; corrected if configured."""
    if config.ocr_backend == "none":
        raise ValueError("no OCR backend is configured")
    images = scans if config.ocr_backend == "images" else plugins.rasterise(scans, renderer, count, config.dpi, config.subset, config.subset_offset)
    seen = stash(plugins.recognise(images, engines), "recognised")  # each page is asked for once
    good = seen.where("error is null").drop("error")
    return plugins.correct(good, corrector if config.correct else None), seen.where("error is not null").drop("text")


def import_layout(spark: SparkSession, source: str, target: str) -> int:
    """Layout files of a finished OCR run as page texts below ``target``; the number of pages."""
    rendered = stash(files.read_layout(spark, source).select("volume", "page", pages.render_blocks("blocks").alias("text")), "layout")
    files.write_page_texts(rendered, target, newline=False)
    return rendered.count()


def prep(docs: DataFrame, config: CorpusConfig) -> DataFrame:
    """(doc, side, text): source texts cleaned, targets as they are; subsets cut by characters."""
    clean = F.when(F.col("side") == "src", T.normalize(F.col("text"))).otherwise(F.col("text"))
    if config.subset:
        clean = T.char_window(clean, 500 * config.subset_offset, 500 * config.subset)
    return docs.select("doc", "side", clean.alias("text"))


def sentences(clean: DataFrame, is_split: bool = False) -> DataFrame:
    """(side, idx, doc, text) with dense numbers a side; with ``is_split`` each line is a sentence already."""
    if is_split:
        lines = clean.select("doc", "side", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("doc", "side", "pos", T.strip(F.col("line")).alias("text"))
        rows = lines.where("text <> ''").select("doc", "side", F.lit(0).alias("para"), "pos", "text")
        return _numbered(rows)
    paras = clean.select("doc", "side", F.posexplode(split.paragraphs(F.col("text"))).alias("para", "p"))
    cut = F.when(F.col("side") == "src", split.split_classical(F.col("p"))).otherwise(split.split_viet(F.col("p")))
    return _numbered(paras.select("doc", "side", "para", F.posexplode(cut).alias("pos", "text")))


def _numbered(rows: DataFrame) -> DataFrame:
    numbered = [ids.dense_index(rows.where(F.col("side") == s), "doc", ["para", "pos"]) for s in ("src", "tgt")]
    return numbered[0].unionByName(numbered[1]).select("side", F.col("idx").cast("long").alias("idx"), "doc", "text")


def embed(rows: DataFrame, config: CorpusConfig, embedder=None) -> DataFrame:
    model = embedder or plugins.hash_embedder(config.embed_dim)
    return rows.withColumn("embedding", model(F.col("text")))


def align_rows(rows: DataFrame, config: CorpusConfig) -> DataFrame:
    """Pairs of each document's sentences; long documents are cut into proportional segments first."""
    size = rows.groupBy("doc", "side").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    most = size.groupBy("doc").agg(F.ceil(F.max("n") / config.segment_rows).alias("segments"))
    placed = rows.join(size, ["doc", "side"]).join(most, "doc").withColumn("segment", F.col("doc") * (1 << 20) + F.floor((F.col("idx") - F.col("first")) * F.col("segments") / F.col("n")))
    beads = align.align(placed.select("segment", "side", "idx", "embedding", F.length("text").cast("double").alias("length")), passes=2 if config.aligner == "twopass" else 1)
    beads = align.above(align.two_sided(beads), config.min_score).withColumn("key", F.struct("segment", "bead"))
    for side in ("src", "tgt"):
        beads = align.gather(beads, rows.where(F.col("side") == side).select("idx", "text"), f"{side}_idx", side, key="key")
    return beads.select("segment", "bead", "src_idx", "tgt_idx", "src", "tgt", "score")


def run(spark: SparkSession, docs: DataFrame, config: CorpusConfig, stage: str = "all", embedder=None) -> DataFrame:
    """Run a stage, or all.  A named stage always runs; ``all`` runs everything; "resume" skips what is done."""
    if stage not in (*ORDER, "all", "resume"):
        raise ValueError(f"unknown stage {stage}")
    manifest, base = Manifest(spark, config.base), config.base
    made: dict[str, Callable[[], DataFrame]] = {
        "prep": lambda: prep(docs, config),
        "split": lambda: sentences(spark.read.parquet(f"{base}/prep"), config.is_split),
        "embed": lambda: embed(spark.read.parquet(f"{base}/split"), config, embedder),
        "align": lambda: align_rows(spark.read.parquet(f"{base}/embed"), config),
        "export": lambda: export.deliverable(spark.read.parquet(f"{base}/align").withColumn("order", F.col("segment") * 4096 + F.col("bead")), "order", config.max_pair_chars, span=1 << 26),
    }
    for name in ORDER:
        if stage == name or stage == "all" or (stage == "resume" and not manifest.done(name)):
            made[name]().write.mode("overwrite").parquet(f"{base}/{name}")
            manifest.mark(name, aligner=config.aligner)
    last = stage if stage in ORDER else ORDER[-1]
    return spark.read.parquet(f"{base}/{last}")
