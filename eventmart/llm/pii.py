"""Personal data by bootstrapped contextual extraction.

Seeds are the matches of four base patterns. The words around a seed form lexical patterns; a
pattern and the identifiers it surrounds are the two sides of a graph that is scored round by
round: a pattern is as sure as the share of its identifiers that are believed, an identifier
that is no seed is believed as its patterns are. Patterns that stay sure, and that several
seeds or values found in earlier rounds back, mark identifiers that the base patterns miss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import col, fresh
from eventmart.session import durable, settled

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3  # different believed values that a pattern needs
SURE = 0.8

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only start at the first digit of a run of digits
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_MARK = re.compile("[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGE = "\"'.,;:!?()[]{}<>|*#$%&="
_PLAIN = re.compile(r"[0-9().+-]+")  # what a token of a number in several tokens consists of
_SPACE = re.compile(r"\s")
_STEP = 64  # characters looked at first for the words beside a token; doubled until they are found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @ in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start; code points, end exclusive."""
    found = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".") if p.lstrip("0")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((3, *m.span()))
    return found


def _words(part: str) -> list[str]:
    return [w for x in part.lower().split() if (w := x.strip(_EDGE))]


class Contexts:
    """Lexical patterns of places of a text that are asked for in rising order.

    A word is what stands between white space, without punctuation at its edges, however long or
    far away; in the token of the place itself, the letters next to it. Tokens and the words beside
    them are looked up once for all places in a token.
    """

    def __init__(self, text: str):
        self.text = text
        self.before = self.after = (0, 0, [])  # token's start and end, words beside it

    def _token(self, at: int) -> tuple[int, int]:
        low = at
        while low and not self.text[low - 1].isspace():
            low -= 1
        space = _SPACE.search(self.text, at)
        return low, space.start() if space else len(self.text)

    def _words_before(self, at: int) -> list[str]:
        step = _STEP
        while True:
            low = max(0, at - step)
            if low:  # the first word may be cut
                space = _SPACE.search(self.text, low, at)
                words = _words(self.text[space.start() : at]) if space else []
            else:
                words = _words(self.text[:at])
            if len(words) >= 2 or not low:
                return words[-2:]
            step *= 2

    def _word_after(self, at: int) -> list[str]:
        step = _STEP
        while True:
            part = self.text[at : at + step]
            words = _words(part)
            if at + step >= len(self.text) or len(words) > 1 or words and part[-1].isspace():
                return words[:1]
            step *= 2

    def of(self, start: int, end: int) -> list[str]:
        """The two words before a place, and the words on both sides of it."""
        text = self.text
        if not self.before[0] <= start < self.before[1]:
            low, high = self._token(start)
            self.before = low, high, self._words_before(low)
        if not self.after[0] <= end - 1 < self.after[1]:
            low, high = self._token(end - 1)
            self.after = low, high, self._word_after(high)
        i = start
        while i > self.before[0] and text[i - 1] in _EDGE:
            i -= 1
        j = i
        while j > self.before[0] and text[j - 1].isalpha():
            j -= 1
        before = [*self.before[2], text[j:i].lower()][-2:] if j < i else self.before[2]
        i = end
        while i < self.after[1] and text[i] in _EDGE:
            i += 1
        j = i
        while j < self.after[1] and text[j].isalpha():
            j += 1
        after = [text[i:j].lower()] if i < j else self.after[2]
        out = [f"{before[0]} {before[1]} _"] if len(before) == 2 else []
        return [*out, f"{before[-1]} _ {after[0]}"] if before and after else out


def shapes(token: str) -> list[int]:
    """Kinds that a token outside the base patterns could be."""
    digits = sum(c in "0123456789" for c in token)
    dots = token.count(".") + token.count(":")
    fits = ("@" in token[1:-1], digits >= 4 and dots >= 3, digits >= 12 and digits >= 0.8 * len(token), digits >= 7 and digits >= 0.6 * len(token))
    return [k for k, fit in enumerate(fits) if fit]


def scan(text: str | None) -> tuple[list, list]:
    """Base spans, and the candidates around which contexts are learned or applied.

    A candidate is (kind or -1, start, end, value, contexts, shapes): each base span, each token
    with a digit or @ that touches none, and each number of 7 to 19 digits that is written in
    several such tokens, as one.
    """
    text = text or ""
    base = base_spans(text)
    seen, by_kind = [], [Contexts(text) for _ in KINDS]
    for k, a, b in base:
        seen.append((k, a, b, text[a:b].lower(), by_kind[k].of(a, b), []))
    if _MARK.search(text):
        places = Contexts(text)
        for a, b in _candidates(text, sorted((a, b) for _, a, b in base)):
            seen.append((-1, a, b, text[a:b].lower(), places.of(a, b), shapes(text[a:b])))
    return base, seen


def _candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    i, reach = 0, -1
    run, digits, run_end = [], 0, -1
    for m in _TOKEN.finditer(text):
        whole = m.group()
        a = m.start() + len(whole) - len(whole.lstrip(_EDGE))
        b = a + len(whole.strip(_EDGE))
        while i < len(taken) and taken[i][0] < m.end():
            reach = max(reach, taken[i][1])
            i += 1
        if reach > m.start() or a >= b:
            continue
        plain = _PLAIN.fullmatch(text, a, b) is not None
        # one space, or brackets and one space, join two tokens of a number
        if not (plain and run and text[run_end : a].strip("()") == " "):
            yield from _joined(run, digits)
            run, digits = [], 0
        if plain:
            run.append((a, b))
            digits += sum(c in "0123456789" for c in text[a:b])
            run_end = b
        else:
            yield a, b
    yield from _joined(run, digits)


def _joined(run: list[tuple[int, int]], digits: int) -> list[tuple[int, int]]:
    return [(run[0][0], run[-1][1])] if len(run) > 1 and 7 <= digits <= 19 else run


_SPAN = "kind int, start long, end long"
_FOUND = f"base array<struct<{_SPAN}>>, seen array<struct<{_SPAN}, value string, contexts array<string>, shapes array<int>>>"


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [scan(t) for t in batch]
        yield pd.DataFrame({"base": [b for b, _ in found], "seen": [s for _, s in found]})


def score_patterns(seen: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, sure: float = SURE) -> DataFrame:
    """(pattern, kind, sureness) of the accepted patterns, from candidate rows.

    sureness = sum of belief over the pattern's different values / (number of values + 0.5). A
    seed is believed 1 for its kind; other values 1 - prod(1 - sureness) over their patterns of the
    last round, for the kinds whose shape they have. A pattern is scored for a kind while at least
    `support` different values are believed to `sure`, be they seeds or found in a round before.
    Edges are distinct (pattern, value) pairs, combined before every shuffle.
    """
    pairs = seen.select(F.explode("contexts").alias("pattern"), "value", "kind", "shapes")
    seeds = durable(pairs.where("kind >= 0").select("value", "kind").distinct(), "seeds")
    edges = durable(pairs.select("pattern", "value").distinct(), "graph")
    sizes = durable(edges.groupBy("pattern").agg(F.count("*").alias("n")), "sizes")
    # a value of no shape can never be believed
    others = pairs.where((F.col("kind") < 0) & (F.size("shapes") > 0)).select("pattern", "value", "shapes").distinct()
    others = durable(others.join(seeds.select("value").distinct(), "value", "left_anti"), "others")
    belief = sure_of_seeds = seeds.withColumn("belief", F.lit(1.0))
    scored = None
    for _ in range(rounds):
        sums = edges.join(belief, "value").groupBy("pattern", "kind").agg(
            F.sum(F.col("belief").cast("decimal(28,12)")).alias("sum"), F.count_if(F.col("belief") >= sure).alias("backing")
        )
        sums = sums.where(F.col("backing") >= support).join(sizes, "pattern")
        scored = sums.select("pattern", "kind", (F.col("sum").cast("double") / (F.col("n") + 0.5)).alias("sureness"))
        scored = durable(scored, "scored")
        doubt = F.log1p(-F.col("sureness")).cast("decimal(28,12)")
        gained = others.join(scored, "pattern").where(F.array_contains("shapes", F.col("kind")))
        gained = gained.groupBy("value", "kind").agg((1 - F.exp(F.sum(doubt).cast("double"))).alias("belief"))
        belief = sure_of_seeds.unionByName(gained)
    return scored.where(F.col("sureness") >= sure)


def _found(docs: DataFrame, text: str) -> tuple[DataFrame, Column, Column]:
    """A durable copy of `docs`, its base spans and all its spans."""
    row, made, more = fresh(docs, "_row"), fresh(docs, "_made"), fresh(docs, "_added")
    rows = docs.withColumn(made, F.pandas_udf(_scan, _FOUND)(col(text))).withColumn(row, F.monotonically_increasing_id())
    rows = durable(rows, "scanned")
    seen = rows.select(col(row), F.inline(f"{made}.seen"))

    def added() -> DataFrame:
        accepted = score_patterns(seen)
        open_ones = seen.where("kind < 0").select(row, "start", "end", "shapes", F.explode("contexts").alias("pattern"))
        hits = open_ones.join(accepted, "pattern").where(F.array_contains("shapes", F.col("kind")))
        best = Window.partitionBy(row, "start").orderBy(F.desc("sureness"), "kind")
        hits = hits.withColumn("nth", F.row_number().over(best)).where("nth = 1")
        return hits.groupBy(row).agg(F.collect_list(F.struct("kind", "start", "end")).alias(more))

    rows = rows.join(settled(added, "added"), row, "left")
    base = F.col(f"{made}.base")
    return rows, base, F.concat(base, F.coalesce(col(more), F.array().cast(f"array<struct<{_SPAN}>>")))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))
    return F.array_join(one, ",")


def _number_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, base, spans (arrays of kind number, start, end), counts and digests.

    base_sha256 and spans_text list kind:start:end, by kind in the order email, ip, card, phone, then
    start. Null and empty texts have no spans. n_* count base spans.
    """
    rows, base, spans = _found(docs.select(col(key).alias("key"), col(text).alias("text")), "text")
    everything = F.array_sort(spans)
    counts = [_number_of(base, k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select(
        F.col("key").alias(key), *counts, F.sha2(_listed(base), 256).alias("base_sha256"), everything.alias("spans"), _listed(everything).alias("spans_text")
    )


def _masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, own in zip(texts, spans, strict=True):
        if text is None:
            out.append(None)
            continue
        parts, at = [], 0
        for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in own):
            if start >= at:
                parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows of `docs`, each found span replaced by its kind in brackets; overlapping spans become one.

    Texts without spans, null and empty ones included, stay as they are.
    """
    rows, _, spans = _found(docs, text)
    touched = F.size(spans) > 0
    # only the texts that change go through Python
    masked = F.pandas_udf(_masked, "string")(F.when(touched, col(text)), spans)
    new = F.when(touched, masked).otherwise(col(text))
    return rows.select(*[new.alias(c) if c.lower() == text.lower() else col(c) for c in docs.columns])
