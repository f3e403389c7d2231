"""Secret scans with DataFrame functions only: fixed patterns, and character Markov models for the rest.

Two chains of characters are counted from labelled samples, one on random strings and one on ordinary identifiers.
A long run of key characters is a secret if the chain of random strings explains it better: the sum of
log-likelihood ratios of its character pairs must reach a total and an average. Such spans are added to those of the
patterns; a run that begins inside an assignment, or holds a span of another pattern, is not listed again.

Positions are code points, ends exclusive. They come from splitting the text at the matches, with running sums over
blocks, so a text of very many matches costs no square. Null texts are empty. Rows are judged one by one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbre.llm.samples import bounded_sample

#: Fixed patterns: what must be found is given in these terms.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

_KEY = "[A-Za-z0-9+/_-]"
#: Runs the models judge: of 20 characters or more, with a letter, and with a digit or a capital after a small letter.
RUN = rf"(?<!{_KEY})(?={_KEY}*[A-Za-z])(?={_KEY}*(?:[0-9]|[a-z][A-Z])){_KEY}{{20,}}={{0,2}}"
_RUN_OR_ASSIGN = rf"{ASSIGN}|{RUN}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
_BLOCK = 64


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratios of character pairs, row by row over the alphabet, and what a secret must reach."""

    ratios: tuple[float, ...]
    least_total: float = 14.0
    least_mean: float = 0.35

    def secret(self, run: Column) -> Column:
        """Whether a run is more likely random."""
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratios)), ",").cast("array<double>")
        spots = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))
        pairs = F.zip_with(F.slice(spots, 1, F.length(run) - 1), F.slice(spots, 2, F.length(run) - 1), _cell)
        total = F.aggregate(pairs, F.lit(0.0), lambda acc, cell: acc + F.element_at(table, cell))
        return (total >= self.least_total) & (total >= self.least_mean * (F.length(run) - 1))


def _cell(a: Column, b: Column) -> Column:
    return (a - 1) * len(ALPHABET) + b


def fit(samples: DataFrame, text_col: str = "text", label_col: str = "random", smooth: float = 0.5) -> Markov:
    """Chains counted from strings labelled random (true) or ordinary (false); characters outside the alphabet and
    nulls do not count. The result has one number per pair of characters, whatever the size of the samples."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "[^A-Za-z0-9+/_=-]", "")
    named = samples.where(F.col(label_col).isNotNull()).select(text.alias("text"), F.col(label_col).alias("random"))
    named = named.where(F.length("text") >= 2)
    spots = F.transform(F.split("text", ""), lambda c: F.instr(F.lit(ALPHABET), c))
    steps = F.zip_with(F.slice(spots, 1, F.length("text") - 1), F.slice(spots, 2, F.length("text") - 1), _cell)
    counts = named.select("random", F.explode(steps).alias("cell")).groupBy("random", "cell").count().collect()
    n = len(ALPHABET)
    tables = {True: [smooth] * (n * n), False: [smooth] * (n * n)}
    for row in counts:
        tables[bool(row["random"])][row["cell"] - 1] += row["count"]
    ratios = []
    for a in range(n):
        rows = {k: t[a * n : a * n + n] for k, t in tables.items()}
        sums = {k: math.log(sum(r)) for k, r in rows.items()}
        ratios += [
            math.log(x) - sums[True] - math.log(y) + sums[False] for x, y in zip(rows[True], rows[False], strict=True)
        ]
    return Markov(tuple(ratios))


#: How often the strings made of these words are counted.
REPEAT = 20
#: Parts of ordinary identifiers, for the labelled samples.
WORDS = """account action active address admin amount application base binary body buffer build bytes cache call channel
check class client close code collection color column common component config connection content context
controller convert count create data database date default delete description device document download element
email engine entry error event example exception false field file filter folder format function global handler
hash header height host image import index info input integer item language length line list load local location
manager message method model module name network node open option order output page param parse password path
pattern payload permission position process profile project property protocol provider python query random range
record release render report request reset resource response result return route runtime sample scale schedule
schema search select server service session socket source start state static status storage stream string style
submit system table target task template test text thread time token total transaction transform tree type
update upload user utils value vector version view visible widget width window worker write""".split()


def samples(docs: DataFrame, text_col: str = "text", rows: int = 2000, id_col: str = "doc_id") -> DataFrame:
    """Labelled strings: identifiers made of the words of at most ``rows`` documents, and random strings.

    Ordinary ones are words, words joined as in code and paths, and words with a number. Random ones are encoded
    hashes, one of each kind per document; their label is known as they are made so.
    """
    few = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    few = bounded_sample(few, "id", rows)
    clean = F.regexp_replace("text", _RUN_OR_ASSIGN, " ")
    words = few.select("id", F.regexp_extract_all(clean, F.lit("[A-Za-z]{2,}"), F.lit(0)).alias("w"))
    joined = F.transform(
        F.filter("w", lambda x, i: i % 4 == 0),
        lambda x, i: F.concat(
            x,
            F.element_at(F.array(*map(F.lit, ("_", "-", "/", "", "_"))), (i % 5 + 1).cast("int")),
            F.initcap(F.element_at("w", F.least(i * 4 + 2, F.size("w")).cast("int"))),
            F.when(i % 3 == 0, (F.abs(F.hash(x)) % 2050).cast("string")).otherwise(F.lit("")),
        ),
    )
    ordinary = words.select(F.explode(F.concat("w", joined)).alias("text"), F.lit(False).alias("random"))
    # as many as the corpus words, or the chain of ordinary strings would know this corpus only
    names = [a + join + (b if join else b.title()) for k, join in enumerate(("_", "-", "/", ""), 1)
             for a, b in zip(WORDS, WORDS[37 * k :] + WORDS[: 37 * k], strict=True)]
    names = F.split(F.lit(" ".join(names + [f"{n}{k % 10}" for k, n in enumerate(names)])), " ")
    spoken = docs.sparkSession.range(REPEAT).select(F.explode(names).alias("text"), F.lit(False).alias("random"))
    ordinary = ordinary.distinct().unionByName(spoken)
    digest = F.unhex(F.sha2(F.concat(F.col("id").cast("string"), F.lit("#")).cast("binary"), 512))
    safe = F.translate(F.base64(digest), "+/", "-_")
    mixed = F.regexp_replace(F.base64(digest), "[^A-Za-z0-9]", "")
    strings = F.array(F.regexp_replace(F.base64(digest), r"\s", ""), safe, mixed, F.upper(mixed), F.lower(mixed), F.lower(F.hex(digest)))
    random = few.select(F.explode(strings).alias("text"), F.lit(True).alias("random"))
    return ordinary.unionByName(random)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _total(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda acc, x: acc + x)


def _before(sizes: Column) -> Column:
    """For each element the sum of those before it, by blocks."""

    def within(sums: Column, blocks: Column) -> Column:
        return F.flatten(
            F.transform(
                blocks,
                lambda own, k: _let(
                    _total(F.slice(sums, F.lit(1), k)),
                    lambda base: F.transform(own, lambda _, i: base + _total(F.slice(own, F.lit(1), i))),
                ),
            )
        )

    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")),
        lambda k: F.slice(sizes, k * _BLOCK + 1, F.lit(_BLOCK)),
    )
    return _let(cut, lambda blocks: _let(F.transform(blocks, _total), lambda sums: within(sums, blocks)))


def _empty() -> Column:
    return F.expr("cast(array() as array<struct<start:int,kind:int,stop:int>>)")


def found(text: Column, kind: int, pattern: str, keep=None, group: int = 0) -> Column:
    """Spans (start, kind, stop) of all matches, leftmost first; ``keep`` judges each match's ``group``."""
    steps = F.zip_with(
        F.transform(F.split(text, pattern, -1), F.length),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length),
        lambda gap, size: F.struct(gap.alias("gap"), F.coalesce(size, F.lit(0)).alias("size")),
    )

    def spans(own: Column) -> Column:
        starts = _before(F.transform(own, lambda s: s["gap"] + s["size"]))
        return F.zip_with(
            own,
            starts,
            lambda s, before: F.struct(
                (before + s["gap"]).alias("start"), F.lit(kind).alias("kind"), (before + s["gap"] + s["size"]).alias("stop")
            ),
        )

    out = F.filter(_let(steps, spans), lambda s: s["stop"] > s["start"])
    if keep is not None:
        judged = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), keep)
        pairs = F.zip_with(out, judged, lambda s, good: F.struct(s.alias("s"), good.alias("good")))
        out = F.transform(F.filter(pairs, lambda p: p["good"]), lambda p: p["s"])
    return F.when(text.rlike(pattern), out).otherwise(_empty())


def _both(text: Column, model: Markov) -> tuple[Column, Column]:
    """Spans of the patterns, and those that only the models find."""

    def fresh(run: Column) -> Column:
        return ~run.rlike(f"^{ASSIGN}") & ~run.rlike(ACCESS) & ~run.rlike(HEX) & model.secret(run)

    base = F.concat(
        found(text, 0, ASSIGN, lambda g: F.length(g) >= ASSIGN_LEAST, 2), found(text, 1, ACCESS), found(text, 2, HEX)
    )
    return base, found(text, 3, _RUN_OR_ASSIGN, fresh)


def scan(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): the spans of the patterns, and those that only the models find."""
    base, added = _both(F.coalesce(F.col(text_col), F.lit("")), model)
    return docs.select(
        F.col(id_col).alias("id"), F.array_sort(base).alias("base"), F.array_sort(added).alias("added")
    )


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:stop, in order of start and then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def all_spans(text: Column, model: Markov) -> Column:
    """Base and added spans of a text, in order of start and then kind."""
    base, added = _both(text, model)
    return F.array_sort(F.concat(base, added))


def redacted(docs: DataFrame, model: Markov, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with every secret in the text replaced by a mark (overlapping ones by one); a null text stays null
    and the other columns stay as they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def cut(spans: Column) -> Column:
        merged = F.aggregate(
            spans,
            F.expr("cast(array() as array<struct<start:int,stop:int>>)"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.coalesce(F.get(done, F.size(done) - 1)["stop"], F.lit(-1)) > s["start"]),
                F.concat(
                    F.slice(done, F.lit(1), F.size(done) - 1),
                    F.array(
                        F.struct(
                            F.get(done, F.size(done) - 1)["start"].alias("start"),
                            F.greatest(F.get(done, F.size(done) - 1)["stop"], s["stop"]).alias("stop"),
                        )
                    ),
                ),
            ).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))),
        )
        stops = lambda m: F.concat(F.array(F.lit(0)), F.transform(m, lambda s: s["stop"]))
        starts = lambda m: F.concat(F.transform(m, lambda s: s["start"]), F.array(F.length(text)))
        return _let(
            merged,
            lambda m: F.array_join(
                F.zip_with(stops(m), starts(m), lambda a, b: F.substring(text, a + 1, b - a)), mark
            ),
        )

    spans = all_spans(text, model)
    clean = F.when(F.size(spans) > 0, _let(spans, cut)).otherwise(F.col(text_col))
    return docs.withColumn(text_col, clean)
