"""Text decoded with the wrong encoding: found, and restored where possible.

A smoothed character 3-gram model is trained on the words of clean records.
Every distinct word that holds other than plain letters is then compared, once,
with what each chain of re-encoding and decoding makes of it; the likeliest
reading is accepted when its log-likelihood exceeds the word's own by a margin,
which was validated on all clean words and their corrupted copies, each word under
a model that has not counted it. What was found out about words is joined back to
the records that hold them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codexmill.session import materialize

#: Single-byte encodings that texts may have been read in.
CODECS = ("cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1251", "cp1250", "iso8859-15")
#: National 7-bit variant (ISO 646-SE) and the characters that its codes are in ASCII.
SEVEN_BIT = dict(zip("{}|[]\\", "äåöÄÅÖ", strict=True))
SEVEN_BIT_CHAIN = "ascii>iso646-se"
#: Counters of each of a model's two tables, 4 bytes each. All n-grams are counted at any size of the corpus;
#: those that share a counter in one table hardly do so in the other, and the smaller one counts.
SLOTS = 1 << 21
#: Parts of the distinct words; each is held out once, of the model on which its words validate the margin.
FOLDS = 5
#: Gain beyond which a word is not counted in the second model.
CLEANER = 1.0
MARGINS = tuple(float(x) for x in range(2, 40))
CACHE_WORDS = 200_000
#: Weights of the interpolation with the next shorter context.
BACKOFF = 3.0
LOST = "\ufffd"
WORD = re.compile(r"[^ \t\r\n]+")
#: What makes a word suspect: other than plain ASCII, or a character that ISO 646-SE uses.
SUSPECT = re.compile(r"[{}|\[\]\\?\x80-\U0010ffff]")
#: The same and control characters for Java.
SUSPECT_J, CONTROL_J = "[{}|\\[\\]\\\\?\\x{80}-\\x{10ffff}]", "[\\x{7f}-\\x{9f}]"
BETWEEN_WORDS = "[ \t\r\n]+"
#: Words with a verdict that are broadcast to the records, about 100 bytes each; more are joined by a shuffle.
BROADCAST_VERDICTS = 500_000
CONTROL = re.compile(r"[\x7f-\x9f]")
ASK_INSIDE = re.compile(r"(?<=[^\W\d_])\?(?=[^\W\d_])")


@lru_cache
def _tables() -> tuple[dict[str, dict[str, int]], dict[str, list[str]]]:
    """Characters to bytes and bytes to characters. Bytes that an encoding
    leaves undefined stand for the control character of the same number, as
    lenient decoders have it."""
    to_char = {}
    for c in CODECS:
        to_char[c] = [bytes([b]).decode(c, "replace") for b in range(256)]
        to_char[c] = [chr(b) if x == LOST else x for b, x in enumerate(to_char[c])]
    to_byte = {c: {x: b for b, x in enumerate(t)} for c, t in to_char.items()}
    return to_byte, to_char


def _bytes(word: str, codec: str) -> bytes | None:
    m = _tables()[0][codec]
    try:
        return bytes([m[x] for x in word])
    except KeyError:
        return None


@lru_cache(maxsize=20_000)
def _swaps(chars: frozenset[str]) -> tuple[tuple[dict[int, str], str], ...]:
    """Every way to re-read these characters one by one, and the chain that
    does it; ways that are alike on them count once."""
    to_byte, to_char = _tables()
    out: dict[tuple[str, ...], tuple[dict[int, str], str]] = {}
    order = sorted(chars)
    for c in CODECS:
        if not all(x in to_byte[c] for x in order):
            continue
        for d in CODECS:
            new = tuple(to_char[d][to_byte[c][x]] for x in order)
            if new != tuple(order) and not CONTROL.search("".join(new)):
                out.setdefault(new, ({ord(x): y for x, y in zip(order, new, strict=True)}, f"{c}>{d}"))
    return tuple(out.values())


def readings(word: str) -> dict[str, str]:
    """Every other reading of a word and the chain that gives it."""
    out: dict[str, str] = {}
    todo, seen = [(word, "", 0)], {word}
    while todo:
        at, chain, depth = todo.pop()
        odd = frozenset(x for x in at if not x.isascii())
        if depth < 2 and odd:
            for table, name in _swaps(odd):
                out.setdefault(at.translate(table), f"{chain}{name}")
        for c in CODECS:
            raw = _bytes(at, c)
            try:
                x = raw.decode("utf-8") if raw is not None else at
            except UnicodeDecodeError:
                continue
            if x in seen:
                continue
            seen.add(x)
            name = f"{chain}{c}>utf-8"
            if not CONTROL.search(x):
                out[x] = name
            if depth < 2 and not x.isascii():
                todo.append((x, name + " ", depth + 1))
    if any(x in SEVEN_BIT for x in word):
        out.setdefault("".join(SEVEN_BIT.get(x, x) for x in word), SEVEN_BIT_CHAIN)
    out.pop(word, None)
    if CONTROL.search(word):
        return {y: chain for y, chain in out.items() if not CONTROL.search(y)}
    return out


def corruptions(word: str) -> Iterator[str]:
    """Wrong readings of a correct word, for validation."""
    utf = word.encode("utf-8")
    t = _tables()[1]
    for c in ("cp1252", "latin-1", "cp850", "mac_roman"):
        once = "".join(t[c][b] for b in utf)
        yield once
        if c == "cp1252":
            yield "".join(t[c][b] for b in once.encode("utf-8"))
    for true, read in (("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp850", "cp1252"), ("mac_roman", "cp1252")):
        raw = _bytes(word, true)
        if raw is not None:
            yield "".join(t[read][b] for b in raw)


TOTAL = "\x03total"
CONTEXT = "\x03"


def grams(word: str) -> Iterator[str]:
    """N-grams of a padded word, and the contexts that were followed by one."""
    x = f"\x02\x02{word}\x03"
    for i in range(2, len(x)):
        yield x[i]
        yield x[i - 1 : i + 1]
        yield x[i - 2 : i + 1]
        yield CONTEXT + x[i - 1]
        yield CONTEXT + x[i - 2 : i]


#: Two tables of ``SLOTS`` counters.
Counts = tuple[np.ndarray, np.ndarray]


class Model:
    """Interpolated 1- to 3-gram model over counts by hash, in fixed memory."""

    def __init__(self, counts: Counts) -> None:
        self.low, self.high = counts
        self.total = self._n(TOTAL) + 1.0
        self.cost = lru_cache(maxsize=CACHE_WORDS)(self._cost)

    def _n(self, gram: str) -> float:
        k = _hash(gram)
        return min(self.low.item(k & (SLOTS - 1)), self.high.item((k >> 32) & (SLOTS - 1)))

    def _context(self, gram: str) -> float:
        return self._n(CONTEXT + gram)

    def _cost(self, a: str, b: str, c: str) -> float:
        """-log P(a b c). The joint probability, because a context that only
        damage makes is rare but foretells what follows it well."""
        first = (self._n(a) + 0.5) / (self.total + 0.5 * 65536)
        one = (self._n(c) + 0.5) / (self.total + 0.5 * 65536)
        second = (self._n(b) + 0.5) / (self.total + 0.5 * 65536)
        ab = (self._n(a + b) + BACKOFF * second) / (self._context(a) + BACKOFF)
        bc = (self._n(b + c) + BACKOFF * one) / (self._context(b) + BACKOFF)
        abc = (self._n(a + b + c) + BACKOFF * bc) / (self._context(a + b) + BACKOFF)
        return -math.log(first * ab * abc)

    def costs(self, word: str) -> list[float]:
        w = f"\x02\x02{word}\x03"
        return [self.cost(w[i - 2], w[i - 1], w[i]) for i in range(2, len(w))]

    def best(self, word: str) -> tuple[float, str | None, str | None]:
        """(gain, reading, chain) of the likeliest other reading. Where a
        reading is as long as the word, only n-grams that hold a character
        which may change are compared."""
        top: tuple[float, str | None, str | None] = (0.0, None, None)
        own = self.costs(word)
        base = sum(own)
        at = sorted({j for i, x in enumerate(word) if not x.isascii() or x in SEVEN_BIT for j in (i, i + 1, i + 2)})
        near = sum(own[j] for j in at if j < len(own))
        for y, chain in readings(word).items():
            if len(y) == len(word):
                w = f"\x02\x02{y}\x03"
                gain = near - sum(self.cost(w[j], w[j + 1], w[j + 2]) for j in at if j < len(own))
            else:
                gain = base - sum(self.costs(y))
            if gain > top[0] and (len(y) != len(word) or self.known(word, y)):
                top = (gain, y, chain)
        return top

    def known(self, word: str, reading: str) -> bool:
        """Whether each character that stands for another one has been seen after
        and before its neighbours. Signs are rarer than any letter, so that a
        reading is likelier proves nothing: 'A|B' is a mark between words."""
        w = f"\x02{reading}\x03"
        return all(self._n(w[i : i + 2]) > 0 and self._n(w[i + 1 : i + 3]) > 0 for i, x in enumerate(word) if x != reading[i])

    def lost_letter(self, word: str) -> float:
        """How much likelier a word is with a letter that is known to stand
        there in place of its '?', 0 where none is."""
        fills = [y for x in "åäöéü" if self.known(word, y := ASK_INSIDE.sub(x, word))]
        return max((sum(self.costs(word)) - sum(self.costs(y)) for y in fills), default=0.0)


def _unlikely_pairs() -> str:
    """UTF-8 sequences of Latin-1 letters and signs as each encoding shows them,
    as a pattern; and controls and replacement characters. Only chooses records
    to train on."""
    _, t = _tables()
    esc = lambda xs: "".join(f"\\x{{{ord(x):x}}}" for x in sorted(set(xs)))
    pairs = [f"[{esc(t[c][0xC2:0xC4])}][{esc(t[c][0x80:0xC0])}]" for c in ("cp1252", "cp850", "mac_roman", "cp1251")]
    return "[\\x{80}-\\x{9f}\\x{fffd}]|" + "|".join(pairs)


def _hash(gram: str) -> int:
    return xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass")) - (1 << 63)


def _tally(words: DataFrame) -> DataFrame:
    """(held, gram, n): counts of the hashed n-grams of (word, n, held)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: defaultdict[int, Counter[str]] = defaultdict(Counter)
        for b in batches:
            for w, n, held in zip(b["word"], b["n"], b["held"], strict=True):
                c = parts[held]
                c[TOTAL] += n * (len(w) + 1)
                for g in grams(w):
                    c[g] += n
        for held, c in parts.items():
            yield pd.DataFrame({"held": held, "gram": [_hash(g) for g in c], "n": list(c.values())})

    held = words.schema["held"].dataType.simpleString()
    return words.mapInPandas(count, f"held {held}, gram bigint, n bigint").groupBy("held", "gram").agg(F.sum("n").alias("n"))


def _load(tally: DataFrame) -> Counts:
    """The model's tables: at most two times ``SLOTS`` sums reach the driver,
    however many n-grams there are."""
    part = lambda k, h: F.struct(F.lit(k).alias("k"), h.bitwiseAND(SLOTS - 1).cast("int").alias("slot"))
    slots = tally.select("n", F.explode(F.array(part(0, F.col("gram")), part(1, F.shiftright("gram", 32)))).alias("x"))
    got = slots.groupBy("x.k", "x.slot").agg(F.sum("n").cast("float").alias("n")).toPandas()
    out = np.zeros((2, SLOTS), dtype=np.float32)
    out[got["k"].to_numpy(), got["slot"].to_numpy()] = got["n"].to_numpy()
    return out[0], out[1]


def distinct_words(texts: DataFrame) -> DataFrame:
    """(word, n, held): every distinct word of (text), how often it stands in
    records without a sign of damage, and the part that it is held out with."""
    #: a column of its own before texts are exploded, else it would be found out again for every word
    clean = (~F.col("text").rlike(_unlikely_pairs())).cast("int")
    words = texts.where("text IS NOT NULL").select("text", clean.alias("clean"))
    words = words.select("clean", F.explode(F.split("text", BETWEEN_WORDS)).alias("word")).where("word <> ''")
    words = words.groupBy("word").agg(F.sum("clean").alias("n"))
    words = words.withColumn("held", F.pmod(F.xxhash64("word"), F.lit(FOLDS)).cast("int"))
    #: few bytes but much work a word: as many tasks as there are cores
    return materialize(words.repartition(2 * words.sparkSession.sparkContext.defaultParallelism, "word"), "words")


def train(every: DataFrame) -> tuple[Counts, float]:
    """(n-gram counts, margin) from ``distinct_words``, over all clean records.

    Words of records that show no sign of damage are counted. Damage that shows
    no sign is rarer than what it damaged: words that the first model would
    sooner re-read are left out of the second. The margin is validated on every
    word of the second; the model returned has them all.
    """
    words = every.where("n > 0")
    shared = words.sparkSession.sparkContext.broadcast(_load(_tally(words)))

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(shared.value)
        for b in batches:
            yield b[np.array([not suspect(w) or m.best(w)[0] <= CLEANER for w in b["word"]], dtype=bool)]

    kept = materialize(words.mapInPandas(keep, words.schema), "kept")
    shared.destroy()
    tally = materialize(_tally(kept), "grams")
    parts = [_load(tally.where(F.col("held") == k)) for k in range(FOLDS)]
    return _together(parts), validated_margin(kept, parts)


def _together(parts: list[Counts]) -> Counts:
    return sum(x[0] for x in parts), sum(x[1] for x in parts)


def gains(words: DataFrame, parts: list[Counts]) -> DataFrame:
    """(clean, top, n): how many of the words that hold other than ASCII, and of
    their corrupted copies, have a gain of ``top`` rounded up. Each is judged by
    what the parts count that its word is not held out with."""
    spark = words.sparkSession
    #: mostly zeros unless the corpus is large
    shared = spark.sparkContext.broadcast(zlib.compress(np.array(parts), 1))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.frombuffer(zlib.decompress(shared.value), dtype=np.float32).reshape(FOLDS, 2, SLOTS)
        out: Counter[tuple[bool, int]] = Counter()
        now, m = None, None
        for b in batches:
            for word, held in zip(b["word"], b["held"], strict=True):
                if held != now:
                    now, m = held, Model(_together([tables[k] for k in range(FOLDS) if k != held]))
                out[True, math.ceil(m.best(word)[0])] += 1
                for x, n in Counter(corruptions(word)).items():
                    out[False, math.ceil(m.best(x)[0])] += n
        yield pd.DataFrame([(*k, n) for k, n in out.items()], columns=["clean", "top", "n"])

    odd = words.where(F.col("word").rlike("[^\\x{0}-\\x{7f}]")).select("held", "word")
    #: few models a task, since a part's words lie together
    odd = odd.repartitionByRange(2 * spark.sparkContext.defaultParallelism, "held", "word").sortWithinPartitions("held", "word")
    return odd.mapInPandas(judge, "clean boolean, top bigint, n bigint").groupBy("clean", F.least("top", F.lit(int(MARGINS[-1]) + 1)).alias("top")).agg(F.sum("n").alias("n"))


def validated_margin(words: DataFrame, parts: list[Counts]) -> float:
    """The margin with the best balance on all clean words, between those left
    alone and their corrupted copies found; a false find weighs as much as
    twenty missed ones."""
    #: two rows a margin
    got = [(r["clean"], r["top"], r["n"]) for r in gains(words, parts).collect()]
    total = {kind: sum(n for c, _, n in got if c == kind) for kind in (True, False)}
    if not total[False]:
        return MARGINS[len(MARGINS) // 3]
    above = lambda kind, t: sum(n for c, x, n in got if c == kind and x > t) / total[kind]
    score = {t: above(False, t) - 20 * above(True, t) for t in MARGINS}
    best = [t for t in MARGINS if score[t] >= max(score.values()) - 1e-3]
    return best[len(best) // 2]


def suspect(word: str) -> bool:
    return SUSPECT.search(word) is not None


class Judge:
    """Verdicts (gain, reading, chain) on words; no reading where the original
    is lost."""

    def __init__(self, counts: Counts, margin: float) -> None:
        self.model, self.margin = Model(counts), margin

    def verdict(self, word: str) -> tuple[float, str | None, str | None]:
        if not any(x.isalnum() or not x.isascii() for x in word):
            return 0.0, None, None
        if LOST in word:
            return math.inf, None, None
        if ASK_INSIDE.search(word):
            gain = self.model.lost_letter(word)
            if gain > self.margin:
                return gain, None, None
        return self.model.best(word)


def verdicts(words: DataFrame, counts: Counts, margin: float) -> DataFrame:
    """(word, gain, reading, chain) of the distinct words that another reading
    makes likelier, each judged once."""
    shared = words.sparkSession.sparkContext.broadcast(counts)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        j = Judge(shared.value, margin)
        for b in batches:
            out = [(w, *v) for w in b["word"] if (v := j.verdict(w))[0] > 0]
            yield pd.DataFrame(out, columns=["word", "gain", "reading", "chain"])

    suspects = words.where(F.col("word").rlike(SUSPECT_J)).select("word")
    return materialize(suspects.mapInPandas(judge, "word string, gain double, reading string, chain string"), "verdicts")


def restored_text(text: str, judged: dict[str, tuple[float, str | None, str | None]], margin: float) -> tuple[str, str | None, str]:
    """(restored text, chains, status). Once a chain is certain, words that it
    makes likelier by less than the margin follow it. Status is ``restored``,
    ``partly`` or ``lost``."""
    sure = {w: v for w, v in judged.items() if v[0] > margin}
    chains = {v[2] for v in sure.values() if v[2]}
    new = {w: v[1] for w, v in judged.items() if v[1] and (w in sure or v[2] in chains)}
    out = WORD.sub(lambda m: new.get(m[0], m[0]), text)
    left = LOST in out or CONTROL.search(out) is not None or any(v[1] is None for v in sure.values())
    return out, ", ".join(sorted(chains)) or None, ("partly" if new else "lost") if left else "restored"


class Restorer:
    """Restores single texts, word by word as the tables are."""

    def __init__(self, counts: Counts, margin: float) -> None:
        self.judge = Judge(counts, margin)

    def restore(self, text: str | None) -> tuple[str, str | None, str] | None:
        """``restored_text``, or None for a text without damage."""
        words = {w for w in WORD.findall(text or "") if suspect(w)}
        judged = {w: v for w in words if (v := self.judge.verdict(w))[0] > 0}
        if text and (CONTROL.search(text) or any(v[0] > self.judge.margin for v in judged.values())):
            return restored_text(text, judged, self.judge.margin)
        return None


def _judged(rows: DataFrame, model_texts: DataFrame | None) -> tuple[DataFrame, DataFrame, float]:
    """(rows, words in them that have a verdict, margin)."""
    rows = rows.select("src_table", "row_id", "text").where("row_id IS NOT NULL AND text IS NOT NULL")
    words = distinct_words(rows)
    counts, margin = train(words if model_texts is None else distinct_words(model_texts))
    v = verdicts(words, counts, margin)
    own: Column = F.array_distinct(F.filter(F.split("text", BETWEEN_WORDS), lambda w: w.rlike(SUSPECT_J)))
    pairs = rows.select("src_table", "row_id", F.explode(own).alias("word"))
    #: one row a word on one side: beyond the bound AQE splits words that stand in most records
    return rows, pairs.join(F.broadcast(v) if v.count() <= BROADCAST_VERDICTS else v, "word"), margin


def found(rows: DataFrame, model_texts: DataFrame | None = None) -> DataFrame:
    """(src_table, row_id) of (src_table, row_id, text): the rows that hold
    wrongly decoded text; see ``restored``."""
    rows, hits, margin = _judged(rows, model_texts)
    sure = hits.where(F.col("gain") > margin).select("src_table", "row_id")
    return sure.unionByName(rows.where(F.col("text").rlike(CONTROL_J)).select("src_table", "row_id")).distinct()


def restored(rows: DataFrame, model_texts: DataFrame | None = None) -> DataFrame:
    """(src_table, row_id, restored, chains, status) of (src_table, row_id,
    text): one row for each row that holds wrongly decoded text.

    Trained on ``model_texts`` (by default the rows themselves, whichever are
    clean). Texts are judged whole. NULL and empty texts are no cases, nor are
    rows without an id; a row delivered twice comes out once; without clean
    records no word is likelier than another and only U+FFFD and control
    characters are found.
    """
    rows, hits, margin = _judged(rows, model_texts)
    one = rows.dropDuplicates(["src_table", "row_id"])
    per = hits.distinct().groupBy("src_table", "row_id").agg(F.collect_list(F.struct("word", "gain", "reading", "chain")).alias("judged"), F.max("gain").alias("top"))
    damaged = one.join(per, ["src_table", "row_id"], "left").where((F.col("top") > margin) | F.col("text").rlike(CONTROL_J))

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, i, text, judged in zip(b["src_table"], b["row_id"], b["text"], b["judged"], strict=True):
                known = {} if judged is None else {x["word"]: (x["gain"], x["reading"], x["chain"]) for x in judged}
                out.append((t, i, *restored_text(text, known, margin)))
            yield pd.DataFrame(out, columns=["src_table", "row_id", "restored", "chains", "status"])

    return damaged.select("src_table", "row_id", "text", "judged").mapInPandas(restore, "src_table string, row_id bigint, restored string, chains string, status string")
