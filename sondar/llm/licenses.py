"""License scans: ordered signature rules behind a keyword prefilter.

A text becomes lower-case words with one space between them.  A rule is tried only
where every word occurs that all its matches hold, which for most texts leaves none.  Matches are
intervals of words: one inside another of a section at least as specific
is suppressed, and of equal intervals the earlier rule stays.  Matches of base phrases
always stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondar.llm.common import fresh, quoted, slices
from sondar.llm.license_rules import BASE, FRAGMENTS, RULES, TIERS

# Everything in ASCII but letters and digits separates words.
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
_SPACES = re.compile(rb"  +")
BLOCK = 1 << 20


@dataclass(frozen=True)
class Rule:
    label: str
    tier: int
    keywords: frozenset[bytes]
    expression: str
    base: bool = False

    def compiled(self) -> re.Pattern[bytes]:
        expression = self.expression.encode()
        # Places of a base phrase may overlap each other.
        return re.compile(rb"(?<= )(?=(" + expression + rb") )" if self.base else rb"(?<= )(?:" + expression + rb")(?= )")


_GROUP = re.compile(r"\(\?:([^()]*)\)(\?|\{\d+,\d+\})?")


def necessary(expression: str) -> frozenset[bytes]:
    """Words that every match of a rule's expression holds."""

    def outside(group: re.Match) -> str:
        inner, optional = group[1], group[2]
        if optional:
            # What may be missing parts words only where its own spaces do.
            return " " if all(p[:1] == " " or p[-1:] == " " for p in inner.split("|")) else "~"
        return "~" if "|" in inner else inner

    while (shorter := _GROUP.sub(outside, expression)) != expression:
        expression = shorter
    return frozenset(w.encode() for w in expression.replace(" ?", "~").split() if w.isalnum())


def rules(sections: dict[str, str] = RULES, base: dict[str, str] = BASE) -> list[Rule]:
    """The rules in order of priority: base phrases, then section by section."""
    made = [Rule(label, 0, frozenset(p.encode().split()), re.escape(p).replace(r"\ ", " "), True) for p, label in base.items()]
    for tier, lines in enumerate(sections.values()):
        for line in lines.strip().splitlines():
            label, expression = line.split(" | ", 1)
            for name, fragment in FRAGMENTS.items():
                expression = expression.replace(name, fragment)
            # The gap takes its own spaces.
            expression = re.sub(r" #(\d+) \??", r"(?: [^ ]+){0,\1} ", expression)
            made.append(Rule(label, tier, necessary(expression), expression))
    return made


def normal(data: bytes) -> bytes:
    """A UTF-8 text as lower-case words with one space before, between and after."""
    return _SPACES.sub(b" ", b" " + data.translate(_WORDS) + b" ")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a normal text in blocks, so that a long text is never a list."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end].split(b" ")
        at = end


Match = tuple[int, int, int]


def resolved(found: Iterable[Match], all_rules: list[Rule]) -> list[Match]:
    """Of (start, end, rule) those that stay, by start."""
    # A match that can suppress another comes before it in this order.
    ordered = sorted(found, key=lambda m: (m[0], -m[1], all_rules[m[2]].tier, m[2]))
    reach = [-1] * len(TIERS)
    kept = []
    for start, end, rule in ordered:
        tier, base = all_rules[rule].tier, all_rules[rule].base
        if base or all(far < end for far in reach[: tier + 1]):
            kept.append((start, end, rule))
        reach[tier] = max(reach[tier], end)
    return kept


class Scanner:
    """Finds the rules' matches in texts."""

    def __init__(self, all_rules: list[Rule] | None = None):
        self.rules = rules() if all_rules is None else all_rules
        self.compiled = [r.compiled() for r in self.rules]
        self.keywords = frozenset().union(*(r.keywords for r in self.rules)) if self.rules else frozenset()
        # A rule waits at the keyword that the fewest rules share.
        shared: dict[bytes, int] = {}
        for r in self.rules:
            for word in r.keywords:
                shared[word] = shared.get(word, 0) + 1
        self.waiting: dict[bytes, list[int]] = {}
        for i, r in enumerate(self.rules):
            self.waiting.setdefault(min(r.keywords, key=lambda w: (shared[w], w)), []).append(i)

    def matches(self, data: bytes) -> tuple[int, list[Match]]:
        """The number of words, and (first word, last word, rule) of what stays."""
        text = normal(data)
        seen: set[bytes] = set()
        count = 0
        for words in _words(text):
            count += len(words) - words.count(b"")
            seen |= self.keywords.intersection(words)
        found = []
        for word in seen:
            for i in self.waiting.get(word, ()):
                if self.rules[i].keywords <= seen:
                    found += [(*m.span(int(self.rules[i].base)), i) for m in self.compiled[i].finditer(text)]
        kept, at, passed = [], 0, 0
        for start, end, i in resolved(found, self.rules):
            # Each word has one space before it.
            passed += text.count(b" ", at, start)
            at = start
            kept.append((passed - 1, passed - 1 + text.count(b" ", start, end), i))
        return count, kept


_MATCH = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("rule", T.IntegerType()), T.StructField("tier", T.StringType()),
    T.StructField("base", T.BooleanType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())])
_ARROW = pa.list_(pa.struct([
    ("label", pa.string()), ("rule", pa.int32()), ("tier", pa.string()), ("base", pa.bool_()),
    ("first_word", pa.int64()), ("last_word", pa.int64())]))


def _scan(all_rules: list[Rule], names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    tiers = list(TIERS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(all_rules)
        for batch in batches:
            for part in slices(batch, "t"):
                counts, found = [], []
                for data in part.column("t").cast(pa.binary()).to_pylist():
                    count, kept = scanner.matches(data or b"")
                    counts.append(count)
                    found.append([
                        {"label": r.label, "rule": i, "tier": tiers[r.tier], "base": r.base, "first_word": a, "last_word": b}
                        for a, b, i in kept for r in [all_rules[i]]])
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(counts, pa.int64()), pa.array(found, _ARROW)],
                    names=[*names, "n_words", "found"])

    return scan


def scan(docs: DataFrame, text: str = "text", all_rules: list[Rule] | None = None,
         n_words: str = "n_words", found: str = "licenses") -> DataFrame:
    """The frame with the number of words of each text and its license matches:
    an array of (label, rule, tier, base, first_word, last_word) by place, words from 0.

    ``rule`` is the place in the list of rules.  A null or empty text has no words and no
    matches; repeated rows are scanned each for itself; the frame's other columns stay,
    whatever their names.  Where it has one called ``n_words`` or ``found``, the new one has an
    underscore before its name (``common.fresh``).
    """
    n_words, found = fresh(docs, n_words), fresh(docs, found)
    names = [f"c{i}" for i in range(len(docs.columns))]
    kept = [quoted(c).alias(n) for c, n in zip(docs.columns, names)]
    schema = docs.select(*kept).schema.add("n_words", T.LongType()).add("found", T.ArrayType(_MATCH))
    done = docs.select(*kept, quoted(text).alias("t")).mapInArrow(_scan(rules() if all_rules is None else all_rules, names), schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)],
                       F.col("n_words").alias(n_words), F.col("found").alias(found))


def summary(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``n_base`` counts all places of base phrases; ``first_word`` and ``last_word`` are the first
    and the last word at which one starts (null without any).  Labels are distinct, sorted
    and joined by commas.  ``score`` is the chance that any match is right, each label of a
    section taken for right with the section's chance.
    """
    found = fresh(docs, "found")
    rows = scan(docs.select(quoted(id_col), quoted(text).alias(fresh(docs, "_t"))), fresh(docs, "_t"), found="found")
    base = F.filter("found", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["first_word"])

    def of_tier(tier: str) -> Column:
        return F.filter("found", lambda m: m["tier"] == tier)

    def labels(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    # Each section's labels, as the share of doubt that they leave.
    doubt = F.lit(1.0)
    for tier, sure in TIERS.items():
        of = F.array_distinct(F.transform(of_tier(tier), lambda m: m["label"]))
        doubt = doubt * F.pow(F.lit(1 - sure), F.size(of).cast("double"))
    return rows.select(
        quoted(id_col), "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        (1 - doubt).alias("score"))
