"""Operator 2 -- line-first cleaning.

Every line of a text is judged on its own: too much punctuation, no sentence
punctuation at all, navigation bars, shouting, boilerplate phrases, one word
over and over, or a repeat of an earlier line. Failing lines are removed; a
document that loses more than ``max_loss_pct`` of its word characters, or that
fails the base counts, is rejected.

Words are runs of ``[^\\x20\\x09-\\x0D]``, lines end at ``\\n``. Null and empty
texts have no words, so they fail the base counts and stay empty. Repeated rows
are judged one by one. Columns that the input already has under an output name
are replaced. An empty table gives an empty result. One pass, no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, table


@dataclass(frozen=True)
class LineRules:
    """Limits of the line and document rules (percentages of characters or words)."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_punct_pct: int = 20
    plain_words: int = 20  # a line this long needs some sentence punctuation
    nav_items: int = 3
    shout_words: int = 5
    max_upper_pct: int = 60
    stuck_words: int = 10  # from here on, no word may take over half of a line
    max_loss_pct: int = 30


# Phrases of licence, rights, consent and navigation lines.
BOILERPLATE = (
    r"(?i)licensed under|is licensed|all rights reserved|copyright (?:\(c\)|©|[0-9])|creative commons"
    r"|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|we use cookies|accept (?:all )?cookies"
    r"|subscribe to our|sign up for|click here|read more|share this|skip to (?:main )?content"
    r"|javascript (?:is|must be)|enable javascript|powered by|lorem ipsum|back to top"
)
NAV_MARKS = ("|", ">", "»", "•", "·", "›", "/")
SYMBOLS = "#*$%&|<>"
ASCII_SPACES = " \t\n\x0b\x0c\r"
PUNCT = r"[!-/:-@\[-`{-~]"

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_removed long, chars_removed long"
)


# What a text must hold for any boilerplate phrase to match (besides odd case variants).
_STEMS = (
    "licensed under", "is licensed", "all rights reserved", "copyright ", "creative commons", "terms of ",
    "privacy policy", "cookie", "accept ", "subscribe to our", "sign up for", "click here", "read more", "share this",
    "skip to ", "javascript ", "enable javascript", "powered by", "lorem ipsum", "back to top",
)
_ODD_CASE = ("\u017f", "\u212a")  # long s and Kelvin sign fold to ASCII letters
_PUNCT_BYTES = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LOWER_BYTES = bytes(range(97, 123))
_MARK_BYTES = frozenset(m.encode() for m in NAV_MARKS)


class LineCleaner:
    """Counts, verdict and cleaned text of one document."""

    def __init__(self, rules: LineRules):
        self.rules = rules
        self.boilerplate = re.compile(BOILERPLATE).search
        self.sentence = re.compile(r"[.!?;:,]").search
        self.upper = regex.compile(r"\p{Lu}").findall
        self.lower = regex.compile(r"\p{Ll}").findall

    def _shouted(self, line: str, raw: bytes) -> bool:
        # plain lower-case letters are a quick proof of the contrary
        small = len(raw) - len(raw.translate(None, _LOWER_BYTES))
        pct = self.rules.max_upper_pct
        if (100 - pct) * (len(line) - small) <= pct * small:
            return False
        up = len(self.upper(line))
        return up > 0 and 100 * up > pct * (up + len(self.lower(line)))

    def line_fails(self, line: str, raw: bytes, words: list[bytes], phrases: bool = True) -> bool:
        r, n = self.rules, len(words)
        if 100 * (len(raw) - len(raw.translate(None, _PUNCT_BYTES))) > r.max_punct_pct * len(line):
            return True
        if n >= r.plain_words and not self.sentence(line):
            return True
        marks = sum(map(_MARK_BYTES.__contains__, words))
        if marks >= r.nav_items and 3 * marks >= n:
            return True
        if n >= r.shout_words and self._shouted(line, raw):
            return True
        if n >= r.stuck_words and 2 * len(set(words)) <= n + 2 and 2 * max(Counter(words).values()) > n:
            return True
        return phrases and self.boilerplate(line) is not None

    def __call__(self, text: str | None) -> tuple[tuple, str]:
        text = text or ""
        raw = text.encode("utf-8", "surrogatepass")
        n_words = len(words := raw.split())
        word_chars = len(text) - sum(map(text.count, ASCII_SPACES))
        n_symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
        low = text.lower()
        phrases = any(s in low for s in _STEMS) or any(c in text for c in _ODD_CASE)
        seen: set[str] = set()
        dups = lines_removed = chars_removed = 0
        left = []
        for line in text.split("\n"):
            code = line.encode("utf-8", "surrogatepass")
            own = code.split()
            if own:
                repeat = line in seen
                seen.add(line)
                dups += repeat
                if repeat or self.line_fails(line, code, own, phrases):
                    lines_removed += 1
                    chars_removed += len(line) - sum(map(line.count, ASCII_SPACES))
                    continue
            left.append(line)
        repeats = repeated_words(words)
        r = self.rules
        failed = n_words < r.min_words or 100 * repeats > r.max_repeat_pct * n_words
        kept = not failed and 100 * chars_removed <= r.max_loss_pct * word_chars
        return (n_words, word_chars, n_symbols, dups, repeats, failed, kept, lines_removed, chars_removed), \
            "\n".join(left)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    k = len(number)
    pairs = ids[:-1] * k + ids[1:]
    if k >= 1 << 20:  # keep the window key within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * k + ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[which] >= 2
    inside = np.zeros(n, dtype=bool)
    for j in range(3):
        inside[j : n - 2 + j] |= twice
    return int(inside.sum())


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), text_col: str = "text",
                cleaned: str | None = "cleaned_text", keep_cols: list[str] | None = None) -> DataFrame:
    """Add the counts, ``base_failed``, ``kept`` and the text left after line removal."""
    names = [c.split()[0] for c in COLUMNS.split(", ")] + ([cleaned] if cleaned else [])
    own = [c for c in (docs.columns if keep_cols is None else keep_cols) if c not in names]
    fields = [*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own), COLUMNS]
    if cleaned:
        fields.append(f"`{cleaned}` string")

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cleaner = LineCleaner(rules)
        for pdf in batches(frames):
            rows = [cleaner(t) for t in pdf["__text"]]
            out = pdf[own].reset_index(drop=True)
            counts = pd.DataFrame([r[0] for r in rows], columns=names[: len(names) - bool(cleaned)])
            out = pd.concat([out, counts], axis=1)
            if cleaned:
                out[cleaned] = [r[1] for r in rows]
            yield out

    return docs.select(*own, F.col(text_col).alias("__text")).mapInPandas(judge, ", ".join(fields))


def op2_line_cleaning(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs, cleaned=None, keep_cols=["doc_id"])


_R = LineRules()
OP2_SQL = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
pos as (select r, unnest(words) as a, generate_subscripts(words, 1) as i from w),
win as (select r, i, a, lead(a) over p as b, lead(a, 2) over p as c from pos window p as (partition by r order by i)),
rep as (select r, i from (select r, i, count(*) over (partition by r, a, b, c) as n from win where c is not null)
        where n >= 2),
inside as (select r, count(distinct i + s) as n_repeat_words from rep, (select unnest([0, 1, 2]) as s) group by r),
lines as (select r, unnest(ls) as line, generate_subscripts(ls, 1) as i
          from (select r, string_split(text, chr(10)) as ls from d)),
lw as (select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws,
       row_number() over (partition by r, line order by i) > 1 as repeated from lines),
lf as (select r, ws, len(ws) as n, repeated, line,
       len(regexp_extract_all(line, '{PUNCT}')) as punct,
       len(list_filter(ws, lambda x: x in ({", ".join(f"'{m}'" for m in NAV_MARKS)}))) as marks,
       len(regexp_extract_all(line, '\p{{Lu}}')) as up, len(regexp_extract_all(line, '\p{{Ll}}')) as low,
       coalesce(list_max(map_values(list_aggregate(ws, 'histogram'))), 0) as top
       from lw where len(ws) > 0),
judged as (select r, repeated, list_sum(list_transform(ws, lambda x: length(x))) as chars,
  repeated or 100 * punct > {_R.max_punct_pct} * length(line)
  or (n >= {_R.plain_words} and not regexp_matches(line, '[.!?;:,]'))
  or (marks >= {_R.nav_items} and 3 * marks >= n)
  or (n >= {_R.shout_words} and up > 0 and 100 * up > {_R.max_upper_pct} * (up + low))
  or (n >= {_R.stuck_words} and 2 * top > n)
  or regexp_matches(line, '{BOILERPLATE}') as fails from lf),
doc as (select r, count(*) filter (repeated) as n_dup_lines, count(*) filter (fails) as n_lines_removed,
        coalesce(sum(chars) filter (fails), 0) as chars_removed from judged group by r),
base as (select w.r, doc_id, len(words) as n_words,
  coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
  coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_dup_lines, 0) as n_dup_lines,
  coalesce(n_lines_removed, 0) as n_lines_removed, coalesce(chars_removed, 0) as chars_removed
  from w left join inside on inside.r = w.r left join doc on doc.r = w.r),
v as (select *, n_words < {_R.min_words} or 100 * n_repeat_words > {_R.max_repeat_pct} * n_words as base_failed from base)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and 100 * chars_removed <= {_R.max_loss_pct} * word_chars as kept,
  n_lines_removed::bigint as n_lines_removed, chars_removed::bigint as chars_removed
from v
"""
