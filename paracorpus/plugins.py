"""Model plug-ins (OCR, correction, embedding, entities) with offline defaults.

A plug-in is a function of the rows of a partition; it is loaded once a worker.  The defaults only keep the
pipeline runnable without models; hashed vectors are not equal in quality to a sentence encoder."""

from __future__ import annotations

import threading
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .operators.split import chunk_text

PROMPT = "Correct the OCR errors in the text between the lines and return only the corrected text.\n---\n{chunk}\n---\n"


def hash_embedder(dim: int = 256, n: int = 3):
    """Unit vectors of hashed character n-grams."""

    crc = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint64)

    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                raw = np.frombuffer(f" {t or ''} ".lower().encode(), np.uint8)
                count = len(raw) - n + 1
                h = np.zeros(max(0, count), np.uint64)
                for i in range(n if count > 0 else 0):
                    h = h * np.uint64(0x100000001B3) + crc[raw[i : i + count]]
                h ^= h >> np.uint64(29)
                sign = np.where(h >> np.uint64(63), 1.0, -1.0)
                v = np.bincount((h % np.uint64(dim)).astype(np.int64), sign, dim) if count > 0 else np.zeros(dim)
                size = float(np.linalg.norm(v))
                out.append((v / size if size else v).astype(np.float32))
            yield pd.Series(out)

    embed.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(embed, ArrayType(FloatType()))


def correct(pages: DataFrame, corrector: Callable[[str], str] | None = None, most: int = 500) -> DataFrame:
    """``pages`` with text corrected chunk by chunk; a chunk whose correction fails stays raw and is counted in ``failed``."""
    if corrector is None:
        return pages.withColumn("failed", F.lit(0).cast("long"))
    names = [c for c in pages.columns if c != "text"]

    def run(batches):
        for pdf in batches:
            texts, failed = [], []
            for chunks in pdf["_chunks"]:
                out, bad = [], 0
                for c in chunks:
                    try:
                        out.append(corrector(PROMPT.format(chunk=c)))
                    except Exception:  # any model failure keeps the raw chunk
                        out.append(c)
                        bad += 1
                texts.append("\n\n".join(out))
                failed.append(bad)
            yield pdf[names].assign(text=texts, failed=failed)

    schema = pages.select(*names, "text").schema.add("failed", "long")
    return pages.select(*names, chunk_text(F.col("text"), most).alias("_chunks")).mapInPandas(run, schema)


class Endpoints:
    """A pool of interchangeable services: each has a count of failures, and the least failing, then least used one is next."""

    def __init__(self, engines: list[Callable]):
        if not engines:
            raise ValueError("no endpoints")
        self.engines, self.lock = list(engines), threading.Lock()
        self.load = [[0, 0] for _ in engines]

    def __call__(self, item, tries: int = 0):
        """The answer of the first endpoint that gives one; each is asked at most once, or ``tries`` of them."""
        asked: set[int] = set()
        error: Exception | None = None
        while len(asked) < (tries or len(self.engines)):
            with self.lock:
                at = min((i for i in range(len(self.engines)) if i not in asked), key=lambda i: (*self.load[i], i))
                self.load[at][1] += 1
            asked.add(at)
            try:
                return self.engines[at](item)
            except Exception as e:  # noqa: BLE001
                error = e
                with self.lock:
                    self.load[at][0] += 1
        raise RuntimeError(f"all {len(asked)} endpoints failed: {error}") from error


def repeats_itself(text: str, n: int = 35, window: int = 128, most: int = 4) -> bool:
    """Does an n-character run come ``most`` times within ``window`` runs, as when a model loops?"""
    seen: dict[str, list[int]] = {}
    for i in range(len(text) - n + 1):
        at = seen.setdefault(text[i : i + n], [])
        at.append(i)
        if len(at) >= most and at[-1] - at[-most] <= window * most:
            return True
    return False


def http_engine(url: str, model: str, prompt: str = "document parsing.", timeout: float = 300.0, most_tokens: int = 8192) -> Callable[[bytes], list[str]]:
    """An engine that asks a chat-completions service over HTTP, at temperature 0."""
    import base64
    import json
    import urllib.request

    def call(content: bytes) -> list[str]:
        image = {"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(content).decode()}}
        body = {"model": model, "temperature": 0.0, "max_tokens": most_tokens, "messages": [{"role": "user", "content": [{"type": "text", "text": prompt}, image]}]}
        request = urllib.request.Request(f"{url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as r:  # noqa: S310
            return [json.load(r)["choices"][0]["message"]["content"] or ""]

    return call


def reachable(urls: list[str], timeout: float = 5.0) -> dict[str, str]:
    """Preflight: what is wrong with each service, "" if nothing is."""
    import urllib.request

    found = {}
    for url in urls:
        try:
            with urllib.request.urlopen(f"{url}/models", timeout=timeout):  # noqa: S310
                found[url] = ""
        except Exception as e:  # noqa: BLE001
            found[url] = str(e) or type(e).__name__
    return found


def recognise(images: DataFrame, engines: Callable[[bytes], list[str]] | list[Callable[[bytes], list[str]]], concurrency: int = 0, guard: bool = True) -> DataFrame:
    """volume, page, text, error of page images; failures become rows with an error, to be tried again.

    Each task asks the endpoints from ``concurrency`` threads (16 an endpoint unless said); a page goes to another endpoint
    when one fails.  With ``guard`` an answer that repeats itself counts as a failure."""
    engines = engines if isinstance(engines, list) else [engines]
    threads = concurrency or 16 * len(engines)

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        def checked(engine):
            def call(content):
                text = "\n".join(engine(content))
                if guard and repeats_itself(text):
                    raise ValueError("the answer repeats itself")
                return text

            return call

        pool = Endpoints([checked(e) for e in engines])

        def one(content):
            try:
                return pool(bytes(content)), None
            except Exception as e:  # noqa: BLE001
                return None, str(e)[:500]

        with ThreadPoolExecutor(threads) as workers:
            for pdf in batches:
                found = list(workers.map(one, pdf["content"]))
                yield pdf[["volume", "page"]].assign(text=[t for t, _ in found], error=[e for _, e in found])

    return images.select("volume", "page", "content").mapInPandas(run, "volume string, page int, text string, error string")


def rasterise(files: DataFrame, renderer: Callable[[bytes, int, int], bytes], count: Callable[[bytes], int], dpi: int = 300, first: int = 0, offset: int = 0) -> DataFrame:
    """volume, page, content: page images of (volume, content) documents, pages ``offset`` + 1 to ``offset`` + ``first`` (all, if
    0).  ``renderer`` draws pages (content, page, dpi); no renderer is part of the repository."""

    def run(batches):
        for pdf in batches:
            for volume, content in zip(pdf["volume"], pdf["content"], strict=True):
                last = count(bytes(content))
                for page in range(offset + 1, (min(last, offset + first) if first else last) + 1):
                    yield pd.DataFrame({"volume": [volume], "page": pd.array([page], "int32"), "content": [renderer(bytes(content), page, dpi)]})

    return files.select("volume", "content").mapInPandas(run, "volume string, page int, content binary")


def gazetteer(column, entries: list[str]):
    """Entities of a fixed list that a text contains."""
    return F.filter(F.array(*[F.lit(e) for e in entries]), lambda e: F.contains(column, e))


def judge(pairs: DataFrame, key: str, raters: dict[str, Callable[[str, str], str]], criteria: tuple[str, ...]) -> DataFrame:
    """unit, rater, criterion, value: each rater answers a pair with a JSON object of whole numbers from 1 to 5 by criterion;
    anything else is null, and an answer that is no JSON object is null for all criteria."""
    import json

    def run(batches):
        for pdf in batches:
            rows = []
            for unit, src, tgt in zip(pdf[key], pdf["src"], pdf["tgt"], strict=True):
                for name, rater in raters.items():
                    try:
                        answer = json.loads(rater(src, tgt))
                    except Exception:  # a model that fails or rambles has no opinion
                        answer = {}
                    for c in criteria:
                        v = answer.get(c) if isinstance(answer, dict) else None
                        rows.append((unit, name, c, v if type(v) is int and 1 <= v <= 5 else None))
            frame = pd.DataFrame(rows, columns=["unit", "rater", "criterion", "value"])
            yield frame.assign(value=frame["value"].astype("Int32"))

    return pairs.select(key, "src", "tgt").mapInPandas(run, "unit long, rater string, criterion string, value int")


def round_trip(pairs: DataFrame, forth: Callable[[list[str]], list[str]], back: Callable[[list[str]], list[str]], column: str = "src", batch: int = 32) -> DataFrame:
    """``pairs`` with ``hyp``: ``column`` translated forth and back, in batches; texts whose translation fails are null."""

    def run(batches):
        for pdf in batches:
            out: list[str | None] = []
            texts = pdf[column].fillna("").tolist()
            for at in range(0, len(texts), batch):
                some = texts[at : at + batch]
                try:
                    out += back(forth(some))
                except Exception:  # noqa: BLE001
                    out += [None] * len(some)
            yield pdf.assign(hyp=out)

    return pairs.mapInPandas(run, pairs.select("*").schema.add("hyp", "string"))
