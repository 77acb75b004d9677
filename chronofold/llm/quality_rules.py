"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule rejects rows by a count over their text. ``plan_cascade`` evaluates every rule on a bounded sample, in one job, and orders the
rules by rejections per cost; ``cascade`` applies them one after the other, and a rule's counts, down to the splitting of the text
into words, are computed only for rows that all rules before it let through. The verdict is a conjunction, so the order never
changes it. Costs are estimated on the sample too, as work, not seconds, so that equal inputs give equal orders: the bytes that each step of a rule's
counts reads, writes, hashes or compares on the sample's own texts, lines, words and windows.

``measure`` adds the base counts to every row, for reports; ``quality_cascade`` judges measured rows, and its rules take the counts that are
there. ``keep_documents`` filters: it measures nothing beyond what the cascade asks for, and the base test is part of it.

Defined cases: a null or empty text has no words and fails the base test; a null id is kept as it is;
repeated rows are judged one by one; columns of the input whose names are those of measured ones are
replaced in the result of ``measure``, all others are kept whatever their names; an empty table gives an empty table (the
cascade keeps its declared order).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import ASCII_SPACE, opaque, space_words, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SAMPLE_ROWS = 512


@dataclass(frozen=True)
class Count:
    """A quantity of a text, in steps that are stored one by one (each step sees those before it by name), the last one being
    the quantity; work: the bytes that the steps go over for a row, from the text and the steps."""

    name: str
    steps: tuple[tuple[str, Callable[[dict[str, Column]], Column]], ...]
    work: Callable[[dict[str, Column]], Column]


@dataclass(frozen=True)
class Rule:
    """rejects: a Column over the counts that the rule needs, true for a row that it rejects (null counts as false)."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[dict[str, Column]], Column]


def _share(part: Column, whole: Column, most: float) -> Column:
    return part > F.lit(most) * whole


def _windows(words: Column) -> Column:
    """64-bit hashes of all windows of five words; null for shorter texts."""
    n = F.size(words)
    places = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
    return F.when(n >= WINDOW, F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(WINDOW)])))


def _ranked(hashes: Column) -> Column:
    """(hash, place) in order, for texts in which some hash occurs twice; null for the others."""
    twins = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(twins, F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))


def _union_of_spans(ranked: Column) -> Column:
    """Words inside windows that occur twice or more, the first occurrence included: places with an equal neighbour are kept
    in order, and the union of their spans is summed."""
    last = F.size(ranked) - 1
    twin = F.filter(
        ranked,
        lambda x, j: ((j > 0) & (F.get(ranked, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]))
        | ((j < last) & (F.get(ranked, F.least(j + 1, last))["h"] == x["h"])),
    )
    starts = F.sort_array(F.transform(twin, lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    folded = F.aggregate(
        starts,
        start,
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).cast("long").alias("n"), s.alias("last")),
    )
    return F.coalesce(F.when(ranked.isNotNull(), folded["n"]), F.lit(0).cast("long"))


def _long(c: Column) -> Column:
    return c.cast("long")


_LINES = ("lines", lambda m: F.regexp_extract_all(m["text"], F.lit("[^\\n]*[^ \\t-\\r][^\\n]*"), F.lit(0)))


def _size(text: Column) -> Column:
    return F.octet_length(text).cast("double")


def _held(items: Column) -> Column:
    """Bytes of an array's strings, and eight for each of them; 0 for none."""
    return F.coalesce(F.aggregate(items, F.lit(0.0), lambda s, x: s + F.octet_length(x) + 8), F.lit(0.0))


def _repeat_work(m: dict[str, Column]) -> Column:
    """The words are cut out, each is hashed in five windows, hashes are compared, and sorted where one occurs twice."""
    places = F.coalesce(F.size(m["hashes"]), F.lit(0)).cast("double")
    sorting = F.when(m["ranked"].isNotNull(), 16 * places * F.log2(F.greatest(places, F.lit(2.0)))).otherwise(0.0)
    return _size(m["text"]) + (1 + WINDOW) * _held(m["words"]) + 16 * F.greatest(places, F.lit(0.0)) + sorting


#: All quantities. One look at a byte is the unit of work.
COUNTS = {
    c.name: c
    for c in (
        Count("n_words", (("n_words", lambda m: _long(F.regexp_count(m["text"], F.lit("[^ \\t-\\r]+")))),), lambda m: _size(m["text"]) + 8 * m["n_words"]),
        Count("word_chars", (("word_chars", lambda m: _long(F.length(F.translate(m["text"], ASCII_SPACE, "")))),), lambda m: _size(m["text"]) + m["word_chars"]),
        Count("n_symbols", (("n_symbols", lambda m: _long(F.regexp_count(m["text"], F.lit(f"[{SYMBOLS}]")))),), lambda m: _size(m["text"]) + 8 * m["n_symbols"]),
        Count("n_lines", (_LINES, ("n_lines", lambda m: _long(F.size(m["lines"])))), lambda m: _size(m["text"]) + _held(m["lines"])),
        Count("n_dup_lines", (_LINES, ("n_dup_lines", lambda m: _long(F.size(m["lines"]) - F.size(F.array_distinct(m["lines"]))))), lambda m: _size(m["text"]) + 2 * _held(m["lines"])),
        Count("n_bangs", (("n_bangs", lambda m: _long(F.octet_length(m["text"]) - F.octet_length(F.replace(m["text"], F.lit("!"), F.lit(""))))),), lambda m: 2 * _size(m["text"]) - m["n_bangs"]),
        Count("n_shouts", (("n_shouts", lambda m: _long(F.regexp_count(m["text"], F.lit("[A-Z]{3,}")))),), lambda m: _size(m["text"]) + 8 * m["n_shouts"]),
        Count(
            "n_repeat_words",
            (
                ("words", lambda m: space_words(m["text"])), ("hashes", lambda m: _windows(m["words"])), ("ranked", lambda m: _ranked(m["hashes"])),
                ("n_repeat_words", lambda m: _union_of_spans(m["ranked"])),
            ),
            _repeat_work,
        ),
    )
}

#: The base test, as rules of the cascade.
BASE = (
    Rule("short", ("n_words",), lambda m: m["n_words"] < MIN_WORDS),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]),
)
#: The production rules on top of it; thresholds are shares of words, characters or lines.
RULES = (
    Rule("symbols", ("n_words", "n_symbols"), lambda m: _share(m["n_symbols"], m["n_words"], 0.1)),
    Rule("duplicate_lines", ("n_lines", "n_dup_lines"), lambda m: _share(m["n_dup_lines"], m["n_lines"], 0.5)),
    Rule("word_length", ("n_words", "word_chars"), lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 25 * m["n_words"])),
    Rule("exclamation", ("n_words", "n_bangs"), lambda m: _share(m["n_bangs"], m["n_words"], 0.5)),
    Rule("upper_case", ("n_words", "n_shouts"), lambda m: _share(m["n_shouts"], m["n_words"], 0.5)),
)
REPORTED = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class _Sheet:
    """A table of rows and the counts that it has so far, under names that no column of the input has."""

    def __init__(self, rows: DataFrame, text: str, have: Sequence[str] = ()):
        self.taken = set(rows.columns)
        self.own: list[str] = []
        self.names: dict[str, str] = {c: c for c in have}
        self.rows = rows
        self.add("text", text_or_empty(text), opaquely=False)

    def fresh(self, name: str) -> str:
        while name in self.taken:
            name = f"_{name}"
        self.taken.add(name)
        self.own.append(name)
        return name

    def add(self, name: str, value: Column, opaquely: bool = True) -> None:
        self.names[name] = self.fresh(f"_{name}")
        self.rows = self.rows.withColumn(self.names[name], opaque(value) if opaquely else value)

    def columns(self) -> dict[str, Column]:
        return {k: F.col(v) for k, v in self.names.items()}

    def count(self, name: str, alive: Column | None = None) -> None:
        """Adds a count with its steps, for the rows alive."""
        for step, value in COUNTS[name].steps:
            if step not in self.names:
                # Where the words are there, they are counted.
                found = _long(F.size(self.columns()["words"])) if step == "n_words" and "words" in self.names else value(self.columns())
                self.add(step, found if alive is None else F.when(alive, found))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed; one narrow pass."""
    sheet = _Sheet(docs, text)
    for name in reversed(REPORTED):
        sheet.count(name)
    m = sheet.columns()
    failed = F.lit(False)
    for rule in BASE:
        failed = failed | rule.rejects(m)
    out = sheet.rows.withColumns({**{n: m[n] for n in REPORTED}, "base_failed": failed})
    return out.drop(*sheet.own)


def plan_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, have: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> list[Rule]:
    """rules ordered by rejections per cost on a sample of at most sample_rows rows; the declared order on ties and without rows.

    The sample is a hash slice of rows, cut at sample_rows. It only sets the order of evaluation. have: counts that the rows have, which
    cost nothing; a rule's cost is the work that its other counts took on the sample, and a look at each row.
    """
    picked = docs.where(F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(8)) == 0).limit(sample_rows)
    sheet = _Sheet(picked, text, have)
    needed = [n for n in dict.fromkeys(n for r in rules for n in r.needs) if n not in have]
    for name in needed:
        sheet.count(name)
    m = sheet.columns()
    effort = [F.coalesce(F.sum(COUNTS[n].work(m)), F.lit(0.0)).cast("double").alias(f"work of {n}") for n in needed]
    found = sheet.rows.agg(F.count(F.lit(1)).alias("rows"), *effort, *[F.count_if(F.coalesce(r.rejects(m), F.lit(False))).alias(r.name) for r in rules]).first()
    if not found["rows"]:
        return list(rules)

    def gain(rule: Rule) -> float:
        # Every row's words are counted before the first rule.
        work = sum(found[f"work of {n}"] for n in rule.needs if n not in have and n != "n_words")
        return found[rule.name] / (found["rows"] + work)

    return sorted(rules, key=lambda r: -gain(r))


def cascade(docs: DataFrame, ordered: Sequence[Rule], have: Sequence[str] = (), text: str = "text", out: str = "rejected_by", first: Column | None = None) -> DataFrame:
    """docs with ``out``: the first rule that rejects a row, null for kept ones. first: a verdict that is known before."""
    sheet = _Sheet(docs, text, have)
    columns = [c for c in docs.columns if c != out]
    sheet.add("verdict", first if first is not None else F.lit(None).cast("string"))
    if "n_words" not in sheet.names:
        sheet.count("n_words")
    for rule in ordered:
        verdict = F.col(sheet.names["verdict"])
        alive = verdict.isNull()
        for name in rule.needs:
            sheet.count(name, alive)
        rejected = F.coalesce(rule.rejects(sheet.columns()), F.lit(False))
        sheet.add("verdict", F.when(alive & rejected, F.lit(rule.name)).otherwise(verdict))
    return sheet.rows.select(*columns, F.col(sheet.names["verdict"]).alias(out))


def apply_cascade(measured: DataFrame, ordered: Sequence[Rule], text: str = "text") -> DataFrame:
    """measured with kept and rejected_by (the first rule that rejects, "base" for the base test; null for kept rows)."""
    judged = cascade(measured, ordered, REPORTED, text, first=F.when(F.col("base_failed"), F.lit("base")))
    return judged.withColumn("kept", F.col("rejected_by").isNull())


def quality_cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measure, plan on a sample of measured rows, whose counts cost nothing any more, and judge every row."""
    measured = measure(docs, text)
    return apply_cascade(measured, plan_cascade(measured, rules, REPORTED, key=key, text=text), text)


def keep_documents(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *RULES), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with their columns."""
    verdict = "_verdict"
    while verdict in docs.columns:
        verdict = f"_{verdict}"
    judged = cascade(docs, plan_cascade(docs, rules, key=key, text=text), text=text, out=verdict)
    return judged.where(F.col(verdict).isNull()).select(*docs.columns)
