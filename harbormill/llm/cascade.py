"""Quality rules as a short-circuit cascade: cost and selectivity from a sample decide the order, never the verdict."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 2_000  # about so many texts are measured to order the rules

SYMBOLS = re.compile(r"[#*$%&|<>]")
BLANKS = " \t\n\x0b\f\r"
LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
# letters stay, white space parts words, the rest goes
_LETTERS_ONLY = bytes(97 if c in LETTERS else 32 if chr(c) in BLANKS else c for c in range(256))
_NO_LETTERS = bytes(c for c in range(128) if c not in LETTERS and chr(c) not in BLANKS)


@dataclass(frozen=True)
class Measure:
    """A value of a text that is made from the values named in ``needs``, at most once a text."""

    needs: tuple[str, ...]
    make: Callable


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the values named in ``needs``; whole numbers only, so every order and engine decides alike."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., bool]


def _repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that the text has twice or more."""
    windows = list(zip(words, islice(words, 1, None), islice(words, 2, None), strict=False))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    total, end = 0, 0  # words before ``end`` are counted
    for at, window in enumerate(windows):
        if times[window] > 1:
            total += at + 3 - max(at, end)
            end = at + 3
    return total


# What a rule can ask for; each stands after what it needs. Words are parted by ASCII white space, as ``bytes.split`` does.
MEASURES = {
    "coded": Measure(("text",), lambda text: text.encode("utf-8", "surrogatepass")),
    "words": Measure(("coded",), lambda coded: coded.split()),
    "n_words": Measure(("words",), len),
    "word_chars": Measure(("text",), lambda text: len(text) - sum(map(text.count, BLANKS))),
    "n_symbols": Measure(("text",), lambda text: len(SYMBOLS.findall(text))),
    "lines": Measure(("coded",), lambda coded: [line for line in coded.split(b"\n") if line and not line.isspace()]),
    "n_lines": Measure(("lines",), len),
    "n_dup_lines": Measure(("lines",), lambda lines: len(lines) - len(set(lines))),
    "n_repeat_words": Measure(("words",), _repeat_words),
    "n_letter_words": Measure(("coded",), lambda coded: len(coded.translate(_LETTERS_ONLY, _NO_LETTERS).split())),
    "n_cut_lines": Measure(("lines",), lambda lines: sum(x.rstrip().endswith((b"...", b"\xe2\x80\xa6")) for x in lines)),
    "n_bullet_lines": Measure(("lines",), lambda lines: sum(x.lstrip().startswith((b"-", b"*", b"\xe2\x80\xa2")) for x in lines)),
}

BASE_RULES = (
    Rule("few words", ("n_words",), lambda n: n < 50),
    Rule("repeats", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 50 * n),
)
RULES = (
    *BASE_RULES,
    Rule("word length", ("n_words", "word_chars"), lambda n, c: not 3 * n <= c <= 10 * n),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("words without letters", ("n_words", "n_letter_words"), lambda n, w: 10 * w < 8 * n),
    Rule("repeated lines", ("n_lines", "n_dup_lines"), lambda n, d: 2 * d > n),
    Rule("cut lines", ("n_lines", "n_cut_lines"), lambda n, c: 10 * c > 3 * n),
    Rule("bullets", ("n_lines", "n_bullet_lines"), lambda n, b: 10 * b > 9 * n),
)


class Text:
    """The values of one text, made when they are first asked for."""

    def __init__(self, text: str | None):
        self.made = {"text": text or ""}

    def __call__(self, name: str):
        if name not in self.made:
            measure = MEASURES[name]
            self.made[name] = measure.make(*map(self, measure.needs))
        return self.made[name]

    def breaks(self, rule: Rule) -> bool:
        return rule.rejects(*map(self, rule.needs))


def all_needs(names: Sequence[str]) -> list[str]:
    """The measures behind ``names``, themselves included, in the order in which they can be made."""
    wanted, stack = set(), list(names)
    while stack:
        name = stack.pop()
        if name in MEASURES and name not in wanted:
            wanted.add(name)
            stack += MEASURES[name].needs
    return [m for m in MEASURES if m in wanted]


@dataclass(frozen=True)
class Estimate:
    """Sample texts that break the same rules (a bit each): their number and the nanoseconds of each measure over them."""

    broken: int
    texts: int
    cost: dict[str, int]


def estimates(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 1) -> list[Estimate]:
    """What ``rules`` reject and measures cost on a random sample of about ``sample_rows`` texts.

    Tasks send a bit mask and one number a measure for each text, and these are summed by mask; no text reaches the driver.
    """
    total = docs.count()
    names = all_needs([n for rule in rules for n in rule.needs])
    if not total:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, spent = [], []
            for value in batch.column("text").to_pylist():
                text, costs = Text(value), []
                for name in names:  # what a measure needs is there already, so this is its own time
                    start = time.perf_counter_ns()
                    text(name)
                    costs.append(time.perf_counter_ns() - start)
                masks.append(sum(text.breaks(rule) << n for n, rule in enumerate(rules)))
                spent.append(costs)
            yield pa.RecordBatch.from_arrays([pa.array(masks, pa.int64()), pa.array(spent, pa.list_(pa.int64()))], ["broken", "spent"])

    sample = docs.select("text").sample(min(1.0, sample_rows / total), seed)
    sums = [F.sum(F.get("spent", F.lit(n))).alias(f"m{n}") for n in range(len(names))]
    found = sample.mapInArrow(run, "broken long, spent array<long>").groupBy("broken").agg(F.count("*").alias("texts"), *sums)
    return [Estimate(r["broken"], r["texts"], {name: r[f"m{n}"] for n, name in enumerate(names)}) for r in found.collect()]


def ordered(rules: Sequence[Rule], sample: Sequence[Estimate], made: Sequence[str] = ()) -> list[Rule]:
    """``rules`` by rejections per cost, each judged on the texts and for the measures that those before it leave.

    ``made`` names measures that are there anyway. Rules alike in that keep their order, as all do without a sample.
    """
    left, alive, done, out = list(enumerate(rules)), list(sample), set(all_needs(made)), []
    while left:
        texts = max(1, sum(e.texts for e in alive))

        def worth(item: tuple[int, Rule], texts: int = texts) -> float:
            n, rule = item
            cost = sum(e.cost[m] for e in alive for m in all_needs(rule.needs) if m not in done) / texts
            rejected = sum(e.texts for e in alive if e.broken >> n & 1)
            return rejected / texts / (cost + 100)  # the call itself takes some 100 ns

        best = max(left, key=worth)
        left.remove(best)
        out.append(best[1])
        done.update(all_needs(best[1].needs))
        alive = [e for e in alive if not e.broken >> best[0] & 1]
    return out


def quality_cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, report: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``docs`` with ``kept``: false as soon as one rule rejects the text.

    A random sample of about ``sample_rows`` rows gives what each measure costs and what each rule rejects. The rules then run
    by rejections per cost, and a text leaves at the first that rejects it, so what only later rules ask for is not measured.
    The sample decides the order alone: the verdict is that of all rules, in any order. The measures named in ``report``
    are made for every text and returned as columns (long).

    Null texts are empty, and an empty text has zero of everything. Every row is judged by itself, repeated rows alike. Other
    columns stay; one called ``kept`` or like a reported measure is replaced. An empty table gives no rows.
    """
    new = [*report, "kept"]
    kept = [f for f in docs.schema.fields if f.name not in new]
    cascade = ordered(rules, estimates(docs, rules, sample_rows), report)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, verdicts = [], []
            for value in batch.column("text").to_pylist():
                text = Text(value)
                counts.append([text(m) for m in report])
                verdicts.append(not any(map(text.breaks, cascade)))
            columns = zip(*counts, strict=True) if counts else [()] * len(report)
            arrays = [batch.column(f.name) for f in kept] + [pa.array(list(c), pa.int64()) for c in columns] + [pa.array(verdicts, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*[f.name for f in kept], *new])

    added = [T.StructField(m, T.LongType(), False) for m in report] + [T.StructField("kept", T.BooleanType(), False)]
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, T.StructType([*kept, *added]))
