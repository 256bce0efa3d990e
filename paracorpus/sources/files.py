"""File scans and sinks of the engine's record shapes; schemas are declared, never inferred."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

SENTENCE = "idx long, text string"
PAIR = "src_idx array<bigint>, tgt_idx array<bigint>, src string, tgt string, score double"
BLOCK = "parsing_res_list array<struct<block_label:string,block_content:string,block_order:int,block_id:int>>"
CELL_LIMIT = 32_767


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one of the session."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="paracorpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read more than once to the shared folder, and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found)


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt", without: str = "") -> DataFrame:
    """name, text of whole files, with line ends folded; names that contain ``without`` are left out."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    found = files.select(name.alias("name"), T.unix_newlines(F.col("value")).alias("text"))
    return found.where(~F.contains("name", F.lit(without))) if without else found


def read_volumes(spark: SparkSession, path: str) -> DataFrame:
    """volume, text of the whole-volume files, in name order; page files in the same folder are left out."""
    return read_texts(spark, path, "tap*.txt", "_page_").withColumnRenamed("name", "volume").orderBy("volume")


def read_parallel(spark: SparkSession, source: str, target: str) -> DataFrame:
    """idx, src, tgt of two line-aligned files, such as a benchmark corpus; lines beyond the shorter file are refused."""
    def numbered(path: str, name: str):
        whole = spark.read.text(path, wholetext=True).select(T.unix_newlines(F.col("value")).alias("t"))
        return whole.select(F.posexplode(F.split(F.rtrim("t", F.lit("\n")), "\n")).alias("idx", name))

    both = numbered(source, "src").join(numbered(target, "tgt"), "idx", "full_outer")
    odd = both.where("src is null or tgt is null").limit(1).count()
    if odd:
        raise ValueError("the two files differ in length")
    return both.select(F.col("idx").cast("long").alias("idx"), "src", "tgt")


def read_pages(spark: SparkSession, *folders: str) -> DataFrame:
    """volume, page, text from the first folder that has page files."""
    for folder in folders:
        if exists(spark, f"{folder}/*_page_*.txt"):
            found = read_texts(spark, folder, "*_page_*.txt")
            volume, page = T.page_of_text(F.col("name"))
            return found.select(volume.alias("volume"), page.alias("page"), "text")
    raise FileNotFoundError(", ".join(folders))


def read_images(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    key, page = T.page_of_image(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))
    return files.select(key.alias("volume"), page.alias("page"), "content")


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """volume, page and blocks; folders that name no volume and files without a page number are left out."""
    files = spark.read.schema(BLOCK).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*_res.json").json(path)
    parent = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"([^/]+)/[^/]+$", 1)
    out = files.select(T.volume_of_pdf(parent).alias("volume"), T.page_of_layout(F.col("_metadata.file_name")).alias("page"), F.col("parsing_res_list").alias("blocks"))
    return out.where("volume is not null and page is not null")


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SENTENCE).json(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    p = spark.read.schema(PAIR).json(path)
    return p.withColumns({c: F.coalesce(c, F.lit("")) for c in ("src", "tgt")})


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_npy(spark: SparkSession, path: str, side: str) -> DataFrame:
    """(side, idx, embedding) of a dense matrix file; its rows are numbered from 0."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                x = np.load(io.BytesIO(content)).astype("f4")
                for at in range(0, len(x), 4096):
                    part = x[at : at + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([side] * len(part)), pa.array(range(at, at + len(part)), pa.int64()), pa.array(list(part), pa.list_(pa.float32()))], ["side", "idx", "embedding"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "side string, idx long, embedding array<float>")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", False).json(path)


def write_tsv(pairs: DataFrame, path: str) -> None:
    """Header, tabs, quotes only where needed and doubled, CRLF: one file in pair order."""
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "lineSep": "\r\n", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    pairs.orderBy("pair_id").coalesce(1).write.options(**options).csv(path)


def _each_file(df: DataFrame, path: str, named) -> None:
    """One file a row below ``path``, written by the tasks through Hadoop's file systems; named(row) gives name and bytes."""
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(fs_path)
    local = path.removeprefix("file://")
    if "://" in local:
        raise ValueError(f"page files are written to mounted folders; {path} is none")

    def run(batches):
        import os

        for batch in batches:
            for row in batch.to_pylist():
                name, content = named(row)
                part = os.path.join(local, f".{name}.part")
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, os.path.join(local, name))  # a task that runs again writes the same file
            yield batch.slice(0, 0)

    df.mapInArrow(run, df.schema).write.format("noop").mode("overwrite").save()


def write_page_texts(pages: DataFrame, path: str, newline: bool = True) -> None:
    """One file a page, ``volume_page_0001.txt``; OCR pages end with a newline, layout pages do not."""
    end = "\n" if newline else ""
    _each_file(pages.select("volume", "page", "text"), path, lambda r: (f"{r['volume']}_page_{r['page']:04d}.txt", ((r["text"] or "") + end).encode()))


def write_images(images: DataFrame, path: str) -> None:
    """One image a page, ``volume_0001.png``."""
    _each_file(images.select("volume", "page", "content"), path, lambda r: (f"{r['volume']}_{r['page']:04d}.png", bytes(r["content"])))


def write_npy(vectors: DataFrame, path: str, rows: int = 1 << 18) -> None:
    """Matrix files of ``rows`` vectors, in idx order: ``part-00000.npy`` holds rows 0 to ``rows`` - 1, and so on."""
    import numpy as np

    def pack(pdf):
        import pandas as pd

        out = io.BytesIO()
        np.save(out, np.stack(pdf.sort_values("idx")["embedding"].to_numpy()).astype("f4"))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "content": [out.getvalue()]})

    parts = vectors.select(F.expr(f"idx div {rows}").alias("part"), "idx", "embedding").groupBy("part").applyInPandas(pack, "part long, content binary")
    _each_file(parts, path, lambda r: (f"part-{r['part']:05d}.npy", r["content"]))


def write_aligner_files(sentences: DataFrame, path: str) -> None:
    """A side's exchange files for an outside aligner: ``text/`` has one deduplicated sentence a line and ``vectors/`` the raw
    f32 rows, both in idx order and in parts of the same row ranges; ``index/`` has each line's own idx."""
    kept = sentences.select("idx", T.newline_to_space(F.col("text")).alias("text"), "embedding").orderBy("idx")
    kept.select("text").write.text(f"{path}/text")
    kept.select(F.col("idx").cast("string")).write.text(f"{path}/index")

    def raw(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            values = [np.asarray(v, "<f4").tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["idx", "raw"])

    kept.select("idx", "embedding").mapInArrow(raw, "idx long, raw binary").write.parquet(f"{path}/vectors")


def write_report(facts: dict, path: str) -> None:
    """Evaluation facts as JSON and as a markdown table, ``report.json`` and ``report.md``."""
    import json
    import os

    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "report.json"), "w", encoding="utf-8") as f:
        json.dump(facts, f, ensure_ascii=False, indent=1)
    with open(os.path.join(path, "report.md"), "w", encoding="utf-8") as f:
        f.write("| metric | value |\n|-|-|\n" + "".join(f"| {k} | {'–' if v is None else v} |\n" for k, v in facts.items()))


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(column).coalesce(1).write.option("lineSep", "").text(path)


def xlsx_bytes(rows: list[tuple], header: list[str]) -> bytes:
    """A workbook of one sheet with inline strings; a cell over the format's limit is refused."""
    def cell(x):
        if len(str(x)) > CELL_LIMIT:
            raise ValueError(f"a cell holds {CELL_LIMIT} characters")
        if isinstance(x, int):
            return f"<c><v>{x}</v></c>"
        clean = "".join(c for c in str(x) if c >= " " or c in "\t\n\r")
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [tuple(header), *rows])
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="pairs" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' + text)
    return out.getvalue()


def write_xlsx(pairs: DataFrame, path: str, most: int = 1_000_000) -> None:
    """A driver-side workbook; the format holds about a million rows, more are refused."""
    rows = pairs.orderBy("pair_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a sheet holds {most} rows")
    with open(path, "wb") as f:
        f.write(xlsx_bytes([tuple(r) for r in rows], pairs.columns))
