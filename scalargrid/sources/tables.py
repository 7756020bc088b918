"""Delimited text with a header of its own per file -> rows with that header.

A *row frame* has the file columns it was given (``path`` and any others), plus

``row``      position of the row in its file, growing
``header``   ARRAY<STRING>, the column names of that file
``values``   ARRAY<STRING>, the cells of the row
``problem``  NULL, or why the file cannot be used (then the only row of it)

The expressions are SQL text: they nest higher-order functions, which reads
better that way and is planned in one call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scalargrid.operators.keyed import KEY_ROWS, attach
from scalargrid.runtime import stage

EMPTY_FILE = "No columns to parse from file"
UNREADABLE = "the file cannot be read"
NOT_UTF8 = "the file is no UTF-8 text"
LONG_ROW = "Error tokenizing data: a row has more cells than the header"

# A cell that starts with a quote goes on to the quote that closes it, past separators and line
# breaks; a quote anywhere else, or one that nothing closes, is a character like any other.
_CELL = r'(?:"(?:[^"]|"")*+")?+[^{mark}\\r\\n]*+'
_RECORD = rf"{_CELL}(?:{{mark}}{_CELL})*+(?:\\r\\n|\\n|\\r|\\z)"
_QUOTED = r'(?s)^"((?:[^"]|"")*+)"(.*)$'
_MARK = r"if(endswith(path, '.tsv'), '\t', ',')"

_STYLES = {
    "snake": r"translate(lower(btrim(c, ' \t\r\n')), ' ', '_')",
    "lower": r"lower(btrim(c, ' \t\r\n'))",
    "raw": "c",
}


def _without_bom(text: str) -> str:
    return rf"ltrim('\ufeff', {text})"


def _by_mark(pattern: str) -> str:
    """A pattern with the separator of the file in it."""
    tab, comma = (pattern.replace("{mark}", mark) for mark in (r"\\t", ","))
    return f"if(endswith(path, '.tsv'), '{tab}', '{comma}')"


def _records(text: str) -> str:
    """Lines of a text; those with quotes are cut by the pattern, all others by line breaks."""
    return rf"""
        if(contains({text}, '"'),
           transform(regexp_extract_all({text}, {_by_mark(_RECORD)}, 0), r -> rtrim('\r\n', r)),
           split({text}, '\\r\\n|\\n|\\r', -1))"""


def _cells(line: str) -> str:
    """Cells of a record, without quotes around them."""
    cut = rf"""transform(
        regexp_extract_all(concat({_MARK}, {line}), {_by_mark("{mark}(" + _CELL + ")")}, 1),
        c -> if(rlike(c, '{_QUOTED}'),
                concat(replace(regexp_extract(c, '{_QUOTED}', 1), '""', '"'), regexp_extract(c, '{_QUOTED}', 2)), c))"""
    return f"""if(contains({line}, '"'), {cut}, split({line}, {_MARK}, -1))"""


def _width(line: str) -> str:
    plain = f"(length({line}) - length(replace({line}, {_MARK}, '')) + 1)"
    return f"""if(contains({line}, '"'), size({_cells(line)}), {plain})"""


def _named(cells: str) -> str:
    """Header cells with a number in place of a blank name."""
    return f"transform({cells}, (c, i) -> if(trim(c) = '', concat('Unnamed: ', i), c))"


def _column_names(named: str, header_style: str) -> str:
    """Column names: repeats are numbered, then all are brought to one style."""
    if header_style not in _STYLES:
        raise ValueError(f"unknown header style {header_style!r}")
    unique = f"""
        transform({named}, (c, i) ->
          if(array_position({named}, c) <= i,
             concat(c, '.', size(filter(slice({named}, 1, i), b -> b = c))), c))"""
    return f"transform({unique}, c -> {_STYLES[header_style]})"


def table_rows(
    docs: DataFrame, header_style: str = "snake", keep_empty: bool = False, first: int | None = None
) -> DataFrame:
    """Row frame from whole documents ``(path, content, ...)``; no shuffle.

    ``.tsv`` files are split at tabs, all others at commas. Quoted cells, CRLF,
    a byte-order mark, blank lines and short rows are understood. With
    ``keep_empty`` a file that has only a header gives one row whose ``row`` is
    NULL, otherwise none. With ``first`` only so many rows are looked at.
    """
    others = [c for c in docs.columns if c != "content"]
    lines = f"filter({_records('_text')}, line -> trim('\\r\\n\\t ', line) != '')"
    if first is not None:
        lines = f"slice({lines}, 1, {first + 1})"
    problem = f"""
        case when _text is null then '{UNREADABLE}'
             when not is_valid_utf8(_text) then '{NOT_UTF8}'
             when size(_lines) = 0 then '{EMPTY_FILE}'
             when exists(_lines, line -> {_width("line")} > {_width("get(_lines, 0)")}) then '{LONG_ROW}'
        end"""
    parsed = (
        docs.selectExpr(*others, f"{_without_bom('content')} as _text")
        .selectExpr(*others, "_text", f"{lines} as _lines")
        .selectExpr(*others, "_lines", f"{problem} as problem")
        .selectExpr(
            *others,
            "problem",
            f"if(problem is null, {_named(_cells('get(_lines, 0)'))}, null) as _named",
            "if(problem is null, slice(_lines, 2, size(_lines)), null) as _body",
        )
        .selectExpr(
            *others,
            # A generator: computed once per file, never repeated in later filters.
            f"""inline(array(named_struct(
                  'problem', problem,
                  'header', {_column_names('_named', header_style)},
                  '_body', _body)))""",
        )
    )
    rows = parsed.selectExpr(*others, "problem", "header", "posexplode_outer(_body) as (_at, _line)")
    if not keep_empty:
        rows = rows.where("_line is not null or problem is not null")
    return rows.selectExpr(
        *others, "problem", "header",
        f"inline(array(named_struct('row', bigint(_at + 1), 'values', {_cells('_line')})))",
    ).select(*others, "row", "header", "values", "problem")


def _clean_lines(lines: DataFrame) -> DataFrame:
    others = [c for c in lines.columns if c not in ("row", "line")]
    return lines.selectExpr(*others, "row", rf"rtrim('\r', {_without_bom('line')}) as line").where("trim(line) != ''")


def line_rows(lines: DataFrame, header_style: str = "snake") -> DataFrame:
    """Row frame from records in lines of their own ``(path, row, line, ...)``.

    For tables that arrive line by line; files are read by ``table_rows``. Row 0 of a path is its
    header. Header and widest row come from one aggregate that combines before the shuffle, is
    stored, and meets the lines by ``keyed.attach``: the lines are not shuffled where the headers can be
    broadcast, and a path with most lines is never one task. So the lines are read twice, or three times.
    """
    others = [c for c in lines.columns if c not in ("row", "line")]
    lines = _clean_lines(lines)
    heads = (
        lines.groupBy("path").agg(
            F.max(F.expr("if(row = 0, line, null)")).alias("_head"),
            F.expr(f"max({_width('line')})").alias("_widest"),
            F.count("*").alias(KEY_ROWS),
        )
        .where("_head is not null")
        .selectExpr(
            "path", KEY_ROWS,
            f"{_named(_cells('_head'))} as _named",
            f"if(_widest > {_width('_head')}, '{LONG_ROW}', null) as problem",
        )
        .selectExpr("path", KEY_ROWS, f"{_column_names('_named', header_style)} as header", "problem")
    )
    # Of an unusable file only the header line stays, to carry the problem.
    return (
        attach(lines, stage(heads, "heads"), ["path"], ["header", "problem"])
        .where("if(problem is null, row > 0, row = 0)")
        .selectExpr(
            *others, "row",
            "problem",
            f"""inline(array(named_struct(
                  'header', if(problem is null, header, null),
                  'values', if(problem is null, {_cells('line')}, null))))""",
        )
        .select(*others, "row", "header", "values", "problem")
    )


def line_heads(lines: DataFrame, header_style: str = "snake") -> DataFrame:
    """``(path, ..., header)`` of tables in lines, without looking at their other lines."""
    others = [c for c in lines.columns if c not in ("row", "line")]
    heads = _clean_lines(lines.where("row = 0")).selectExpr(*others, f"{_named(_cells('line'))} as _named")
    return heads.selectExpr(*others, f"{_column_names('_named', header_style)} as header")


def line_cells(lines: DataFrame) -> DataFrame:
    """``(path, row, column, cell)`` of all lines but the headers; which file a line is from needs no header."""
    return _clean_lines(lines.where("row > 0").select("path", "row", "line")).selectExpr(
        "path", "row", f"posexplode({_cells('line')}) as (column, cell)"
    )


def table_cells(rows: DataFrame) -> DataFrame:
    """One row per cell ``(..., row, column, name, cell)``; short rows are padded."""
    others = [c for c in rows.columns if c not in ("header", "values", "problem", "row")]
    return (
        rows.where("problem is null and row is not null")
        .selectExpr(*others, "row", "values", "posexplode(header) as (column, name)")
        .selectExpr(*others, "row", "column", "name", "get(values, column) as cell")
    )
