"""Inputs of the corpus shapes, derived from the tables by expressions that Spark and DuckDB both read."""

#: Marked-up text: a header line, full-width marks, bracket markers, blank-line paragraphs, indented lines.
MARKED = "concat('## h', chr(10), replace(replace(translate(text, '.,!?', '。，！？'), ' the ', '【x】the '), chr(10), concat(chr(10), chr(10), chr(10), ' ')))"
#: Terminators of the classical side only.
CLASSICAL = "translate(text, '.,!?', '。，！？')"
#: Annotations with a terminator inside.
ANNOTATED = f"replace({CLASSICAL}, ' the ', ' 〈the。〉 ')"
#: Mixed marks of the modern side.
MODERN = "replace(translate(text, ';', '；'), ', ', '！ ')"
#: Full-width and ideographic-space forms.
WIDE = "translate(text, 'aeiou .!', 'ａｅｉｏｕ　．！')"
#: White space of several kinds.
SPACED = "concat(chr(9), replace(text, ' ', concat(' ', chr(9), '　')), chr(10))"
#: Grounded OCR answers.
GROUNDED = "concat('<|ref|>', text, '<|/ref|>', '<|det|>[1,2]', chr(10), '</tag><|/det|>', '  ', chr(10), chr(10), chr(10), chr(10), 'x ')"
#: Blank-line paragraphs.
PARAGRAPHS = "replace(text, chr(10), concat(chr(10), chr(10)))"

VOLUME = "concat('tap', cast(4 + doc_id % 3 as varchar(9)))"
PAGE = {"spark": "cast(doc_id div 3 + 1 as int)", "duckdb": "cast(doc_id // 3 + 1 as integer)"}
