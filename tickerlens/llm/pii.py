"""Operator 10: personal data by exact base patterns and bootstrapped context patterns.

Base: the contract's four regular expressions, with checks of range, checksum and digit count.
Bootstrapping: base matches are the seeds. Candidates are the spans a context may enclose: those
of a looser shape (a number glued to its neighbour, ``name at host dot org``) and any word with
an @, group of hex digits with colons, or whole chain of 7 to 15 digits (13 to 19 with a card's
checksum). The words before and after a seed or a candidate are its lexical patterns. Patterns
and instances form a graph which Spark scores in rounds: a pattern's confidence is the mean score
of its instances (seeds 1, smoothed by ``SMOOTH`` unknown ones), a candidate's score is the
noisy-or of its patterns with at least ``MIN_SEEDS`` different seeds. Candidates that reach
``ACCEPT`` become seeds, and the rounds start again until none is added. They are added to the
spans of every text that holds them; base spans always stay.

Offsets are code points, ends exclusive. Cases: null text is empty; rows that repeat an id
are rows of their own; a null id is kept; a text without matches has the digest of the empty
string and empty spans; texts of any length are scanned whole (every pattern is linear);
an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlens.llm.tables import stored
from tickerlens.session import ensure_shipped

KINDS = ("email", "ip", "card", "phone")
SMOOTH, MIN_SEEDS, ACCEPT = 1.0, 2, 0.6
STABLE = 0.001  # rounds end when no score rises by more; scores only rise, and stay below 1

# Matches of the contract's patterns; the possessive forms and the local part's look-up from
# the @ find the same spans without rescanning long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Looser shapes of the same kinds: candidates that only a trusted context makes a finding.
_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(] ?(?:at|@) ?[\])] ?| at | ?@ ?)[A-Za-z0-9-]++"
                        r"(?:(?: ?[\[(] ?(?:dot|\.) ?[\])] ?| dot |\.)[A-Za-z0-9-]++)++"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?: ?[\[(] ?(?:dot|\.) ?[\])] ?| dot )[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}


# Broad tests of characters for what a trusted context may enclose.
_WORD_AT = re.compile(r"(?<![^\s@<>()\[\]{},;:\"'])[^\s@<>()\[\]{},;:\"']++@[^\s@<>()\[\]{},;:\"']++")
# Words of a context; a run of letters and digits touches few spans, so all contexts of a text
# together are no longer than some times the text.
_CONTEXT = re.compile(r"\w+")
_COLONS = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){2,7}+(?![0-9A-Za-z:])")
_CHAIN = re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[ ().\-/]{0,3}[0-9])*+(?![A-Za-z])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i & 1:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: before each @ the longest run of local characters since the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and not _NOT_LOCAL.match(text, lo - 1, lo):
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)  # no local part reaches back over an @
        at = text.find("@", max(at + 1, done if m else 0))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def _plausible(kind: str, value: str) -> bool:
    if kind == "card":
        return luhn(_digits(value))
    if kind == "ip":
        return all(map(_small, re.findall(r"[0-9]+", value)))
    return True


def broad(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of all that passes a broad test of its characters."""
    if "@" in text:
        for m in _WORD_AT.finditer(text):
            end = m.start() + len(m[0].rstrip(".!?"))
            if text[end - 1] != "@":
                yield 0, m.start(), end
    if "::" in text or text.count(":") > 2:
        for m in _COLONS.finditer(text):
            if _DIGIT.search(m[0]) and ("::" in m[0] or m[0].count(":") > 2):
                yield 1, *m.span()
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() > 6:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                yield 2, *m.span()
            elif 7 <= len(d) <= 15:
                yield 3, *m.span()


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of a looser shape, then those of the broad tests, that touch no base span and not each other."""
    out = []
    busy = bytearray(len(text))

    def take(kind: int, a: int, b: int) -> None:
        if busy.find(1, a, b) < 0:
            out.append((kind, a, b))
            busy[a:b] = b"\1" * (b - a)

    for _, a, b in taken:
        busy[a:b] = b"\1" * (b - a)
    loose_words = "@" in text or "at" in text  # every loose address has one of them
    has_digit = _DIGIT.search(text) is not None
    for i, kind in enumerate(KINDS):
        if not (loose_words if kind == "email" else has_digit):
            continue
        for m in _LOOSE[kind].finditer(text):
            a, b = m.span()
            if kind == "email" and not re.search(r"@|\bat\b", m[0]):
                continue
            if _plausible(kind, m[0]):
                take(i, a, b)
    for span in broad(text):
        take(*span)
    return out


def _word(s: str) -> str:
    return re.sub(r"[0-9]+", "0", s.lower())


class Contexts:
    """Lexical patterns around the spans of a text."""

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in _CONTEXT.finditer(text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def of(self, a: int, b: int) -> list[str]:
        """The word before, the two before, the word after; a word that a span cuts counts up to it."""
        text, i, j = self.text, bisect_left(self.starts, a), bisect_right(self.ends, b)
        left = [_word(text[self.starts[k]:min(self.ends[k], a)]) for k in range(max(0, i - 2), i)]
        out = [f"{left[-1]} _" if left else "^ _",
               f"_ {_word(text[max(self.starts[j], b):self.ends[j]])}" if j < len(self.starts) else "_ $"]
        if len(left) > 1:
            out.append(f"{left[0]} {left[1]} _")
        return out


def contexts(text: str, a: int, b: int) -> list[str]:
    return Contexts(text).of(a, b)


MENTION = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()),
                     ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])
SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document with its base spans and its mentions (seeds and candidates)."""
    ensure_shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            rows = []
            for text in b.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                mentions, more = [], candidates(text, base)
                around = Contexts(text) if base or more else None
                for seed, spans in ((True, base), (False, more)):
                    for k, x, y in spans:
                        # a value is known by its kind's digits or lower-case characters, hashed to a fixed length
                        plain = text[x:y].lower() if k < 2 else _digits(text[x:y])
                        mentions.append({"kind": k, "start": x, "end": y, "seed": seed, "patterns": around.of(x, y),
                                         "value": xxhash.xxh128_hexdigest(plain.encode())})
                sha = hashlib.sha256(",".join(f"{KINDS[k]}:{x}:{y}" for k, x, y in base).encode()).hexdigest()
                count = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                rows.append((f"{part}-{n}", *count, sha, [{"kind": k, "start": x, "end": y} for k, x, y in base], mentions))
                n += 1
            cols = list(zip(*rows)) or [[]] * 8
            kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.list_(SPAN), pa.list_(MENTION)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                                             names=["doc_id", "rid", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "mentions"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, rid string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                                "base array<struct<kind: int, start: long, end: long>>, mentions array<struct<kind: int, start: long, "
                                "end: long, value: string, seed: boolean, patterns: array<string>>>")


def score(edges: DataFrame) -> DataFrame:
    """(kind, value, score) of the candidates, by rounds over the pattern-instance graph until no
    score rises by more than ``STABLE``."""
    # in the rounds a pattern's seeds and instances stay; only its candidates' scores change
    fixed = stored(edges.groupBy("kind", "pattern").agg(F.sum(F.col("seed").cast("long")).alias("seeds"), F.count(F.lit(1)).alias("n"))
                   .where((F.col("seeds") >= MIN_SEEDS) & (F.col("n") > F.col("seeds"))), "pii-patterns")
    open_ = stored(edges.where("NOT seed").select("kind", "pattern", "value").join(fixed, ["kind", "pattern"]), "pii-open")
    scores = None
    while True:
        known = open_ if scores is None else open_.join(scores, ["kind", "value"], "left")
        gain = F.lit(0.0) if scores is None else F.coalesce("score", F.lit(0.0))
        trust = stored(known.groupBy("kind", "pattern", "seeds", "n").agg(F.sum(gain).alias("gained"))
                       .select("kind", "pattern", ((F.col("seeds") + F.col("gained")) / (F.col("n") + SMOOTH)).alias("trust")), "pii-trust")
        doubt = F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999)))))
        new = stored(open_.select("kind", "pattern", "value").join(trust, ["kind", "pattern"]).groupBy("kind", "value")
                     .agg((1 - doubt).alias("score")), "pii-scores")
        rise = new if scores is None else new.join(scores.withColumnRenamed("score", "old"), ["kind", "value"]).where(F.col("score") > F.col("old") + STABLE)
        scores = new
        if rise.isEmpty():
            return scores


def bootstrap(mentions: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(kind, value) of the accepted candidates: each pass counts those accepted before as seeds,
    until a pass adds none."""
    edges = stored(mentions.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
                   .groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed")), "pii-edges")
    accepted = None
    while True:
        new = stored(score(edges).where(F.col("score") >= accept).select("kind", "value"), "pii-accepted")
        if new.isEmpty():
            return new if accepted is None else accepted
        accepted = new if accepted is None else stored(accepted.unionByName(new), "pii-accepted")
        found = new.withColumn("found", F.lit(True))
        edges = stored(edges.join(found, ["kind", "value"], "left")
                       .select("kind", "pattern", "value", (F.col("seed") | F.coalesce("found", F.lit(False))).alias("seed")), "pii-edges")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and the number of added spans."""
    rows = stored(scan(docs, id_col, text_col), "pii-rows")
    mentions = rows.select("rid", F.inline("mentions"))
    good = bootstrap(mentions, accept).distinct()
    extra = stored(mentions.where("NOT seed").select("rid", "kind", "value", "start", "end"), "pii-candidates")
    added = (extra.join(good, ["kind", "value"]).groupBy("rid")
             .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))  # spans of one text
    empty = F.expr("cast(array() as array<struct<kind: int, start: long, end: long>>)")
    every = F.array_sort(F.concat("base", F.coalesce("added", empty)))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return (rows.drop("mentions").join(added, "rid", "left")
            .select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.array_join(text, ",").alias("spans"),
                    F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added")))
