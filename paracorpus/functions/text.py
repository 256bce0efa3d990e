"""Text cleaning and name parsing as Column functions; everything stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as ``str.strip`` and ``str.split`` know it, as a Java class and as an RE2 class.
WS = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0  -     　]"
RE2_WS = r"[\t\n\v\f\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters as text, for trimming.
WS_CHARS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
#: White space that ends no line, and line ends.
INLINE_WS = r"[\t\x1F\x20\xA0  -   　]"
LINE_END = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85  ]"
RE2_LINE_END = r"[\n\v\f\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
#: Full-width forms of the printable ASCII characters, by rule.
HALF = "".join(chr(c) for c in range(0x21, 0x7F))
FULL = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
#: Sentence ends, bracket markers and header lines of the corpus.
TERMINATORS = "。！？；!?;"
BRACKET_MARK = "【[^】]*】"
HEADER_LINE = r"(?mUd)^(?:姊妹计划\s*[:：].*|数据项|#.*|\s*---+\s*)$"


def strip(c) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def unix_newlines(c) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def strip_brackets(c) -> Column:
    """Delete closed 【…】 markers, across lines too."""
    return F.regexp_replace(c, BRACKET_MARK, "")


def strip_headers(c) -> Column:
    """Delete wiki header lines; the empty line stays, which may end a paragraph."""
    return F.regexp_replace(c, HEADER_LINE, "")


def fold_fullwidth(c) -> Column:
    return F.translate(c, FULL, HALF)


def collapse_newlines(c) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def paragraph_lines(c) -> Column:
    """Strip lines, drop blank ones, keep blank-line paragraph breaks, end with one newline."""
    def lines(p):
        return F.array_join(F.filter(F.transform(F.split(p, LINE_END), strip), lambda x: x != ""), "\n")

    kept = F.filter(F.transform(F.split(c, r"\n{2,}"), lines), lambda p: p != "")
    return F.concat(strip(F.array_join(kept, "\n\n")), F.lit("\n"))


def normalize(c) -> Column:
    """The whole cleaning chain; it is not idempotent, so never run it on clean text."""
    for step in (strip_brackets, strip_headers, fold_fullwidth, collapse_newlines, paragraph_lines):
        c = step(c)
    return c


def char_window(c, offset: int, n: int) -> Column:
    return F.substring(c, offset + 1, n)


def flatten_ws(c) -> Column:
    return strip(F.regexp_replace(c, f"{WS}+", " "))


def newline_to_space(c) -> Column:
    return strip(F.translate(c, "\n\r", "  "))


def rstrip_newlines(c) -> Column:
    return F.rtrim(c, F.lit("\n"))


def clean_grounding(c) -> Column:
    """Remove detection spans and reference tags of a grounded OCR answer, trailing blanks and blank runs."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)<\|det\|>.*?<\|/det\|>", "")
    c = F.regexp_replace(c, r"<\|/?ref\|>", "")
    return strip(collapse_newlines(F.regexp_replace(c, rf"(?m){INLINE_WS}+(?=\n|\z)", "")))


def rule_fix(c, rules: dict[str, str] | None = None) -> Column:
    """Literal replacements of single characters."""
    rules = rules or {"ℓ": "l", "ñ": "n"}
    return F.translate(c, "".join(rules), "".join(rules.values()))


# -- names ------------------------------------------------------------------------------------


def volume_key(stem) -> Column:
    """tap4..tap6 if the lower-cased stem names one, the accented spelling first, else the stem itself, shortened."""
    low = F.lower(stem)
    out = None
    for spelling, n in ((s, n) for s in ("tập", "tap") for n in (4, 5, 6)):
        test = low.contains(f"{spelling} {n}")
        out = F.when(test, F.lit(f"tap{n}")) if out is None else out.when(test, F.lit(f"tap{n}"))
    return out.otherwise(F.substring(F.replace(stem, F.lit(" "), F.lit("_")), 1, 32))


def page_of_image(name) -> tuple[Column, Column]:
    """(key, page) of ``key_0012``."""
    pattern = r"^(.*)_([^_]*)$"
    return F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2).try_cast("int")


def page_of_text(stem) -> tuple[Column, Column]:
    """(first part, page) of ``a_b_n``; any other stem is itself, with page -1."""
    parts = F.split(stem, "_")
    three = F.size(parts) == 3
    return F.when(three, F.get(parts, F.lit(0))).otherwise(stem), F.coalesce(F.when(three, F.get(parts, F.lit(2)).try_cast("int")), F.lit(-1))


def volume_of_pdf(stem) -> Column:
    n = F.regexp_extract(stem, r"(?iu)tập\s*([456])", 1)
    return F.when(n != "", F.concat(F.lit("tap"), n))


def page_of_layout(name) -> Column:
    return F.regexp_extract(name, r"_(\d+)_res\.json$", 1).try_cast("int")


def data_url(content, name) -> Column:
    """A base64 data URL; the kind follows the suffix, png by default."""
    suffix = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    mime = F.when(suffix.isin("jpg", "jpeg"), "image/jpeg").when(suffix == "webp", "image/webp").otherwise("image/png")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.regexp_replace(F.base64(content), "[\r\n]", ""))
