"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one
bit per failed rule; policies (versioned sets of rules) and ablations are bit operations
on the stored mask, so a new policy never reads a text again.

What is toxic is also learned: a lexicon for each language holds the words that labelled
toxic documents contain far more often than clean ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from oddsline.llm.common import join_nulls, row_batches, unit, written

#: Characters counted as symbols, and words that insult.
SYMBOLS = "#*$%&|<>"
INSULTS = frozenset((
    "clown", "disgusting", "idiot", "idiots", "loser", "losers", "moron", "morons",
    "pathetic", "scum", "stupid", "trash", "worthless"))
SPACES = b" \t\n\x0b\x0c\r"
MARKED = re.compile(rb"!!(?=[ \t\n\x0b\x0c\r]|\Z)")

#: Characters of scripts that put no spaces between words.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")
#: A word of more code points is endless.
ENDLESS = 1000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_shouted", "n_marked", "n_insults", "n_unspaced", "n_endless", "n_echoes")
#: Measured with a lexicon, else 0: its words in the text, and places where two are close.
LEARNED = ("n_toxic", "n_toxic_close")
SCHEMA = ", ".join(f"{m} long" for m in MEASURES + LEARNED)
#: A word is toxic if this many toxic documents of its language hold it, and this share of
#: them, and if toxic ones hold it so many times as often as clean ones.
MIN_DOCUMENTS, MIN_SHARE, MIN_RATIO = 3, 0.01, 20
#: Two toxic words are close if they are fewer words apart.
CLOSE = 50
_EDGES = ".,;:!?\"'()*#$%&|<>\u00ab\u00bb\u201c\u201d\u201e\u2018\u2019\u00bf\u00a1"
Lexicon = dict[str | None, frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """A rule: its name and the condition, over the measurements, under which a document fails."""
    name: str
    fails: str


#: The position of a rule is its bit, so rules are only ever appended.
RULES = (
    Rule("too_short", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars - n_unspaced > 15 * n_words"),
    Rule("shouting", "100 * n_shouted > 50 * n_words"),
    Rule("exclamation", "100 * n_marked > 30 * n_words"),
    Rule("insults", "n_insults >= 2 AND 400 * n_insults >= n_words"),
    Rule("endless_word", "10 * n_endless > word_chars"),
    Rule("echoes", "100 * n_echoes > 25 * n_words"),
    Rule("toxic_words", "n_toxic >= 3 OR n_toxic_close >= 1"),
)
BASE = ("too_short", "repeated_windows")
POLICIES = {
    1: BASE,
    2: (*BASE, "symbols", "duplicate_lines", "word_length", "shouting", "exclamation"),
    3: tuple(r.name for r in RULES[:10]),
    4: tuple(r.name for r in RULES),
}
#: Policy 4 adds the rule that reads a lexicon; without one, it judges as policy 3.
CURRENT = 4
#: Labelled documents that teach a lexicon; of more, those with the smallest hashes of their ids.
TAUGHT = 200_000


def policy_mask(version: int = CURRENT) -> int:
    bits = {rule.name: 1 << i for i, rule in enumerate(RULES)}
    return sum(bits[name] for name in POLICIES[version])


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; all 0 for null or no words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # splits bytes at exactly the six white-space characters
    n = len(words)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    if not n:
        return (0, 0, symbols, *[0] * 9)
    inked = raw.translate(None, SPACES)
    chars = len(inked.decode("utf-8", "surrogatepass"))
    ids, distinct = numbered(words)
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    shouted = sum(map(bytes.isupper, words))
    marked = len(MARKED.findall(raw)) if b"!!" in raw else 0
    insults = 0
    lowered = raw.lower()
    if any(word.encode() in lowered for word in INSULTS):
        insults = sum(word.strip(b".,;:!?\"'()*#$%&|<>").decode("utf-8", "replace") in INSULTS
                      for word in lowered.split())
    unspaced = len(UNSPACED.findall(text)) if HIGH.search(raw) else 0
    return (n, chars, symbols, len(lines) - len(set(lines)),
            repeated_words(ids, distinct), len(lines),
            shouted, marked, insults, unspaced, endless(words), int((ids[1:] == ids[:-1]).sum()))


#: First bytes of the characters from U+0800 to U+FFFF, among which are the unspaced scripts.
HIGH = re.compile(rb"[\xe0-\xef]")


def endless(words: list[bytes]) -> int:
    """Code points in endless words, those of unspaced scripts left out."""
    total = 0
    for word in words:
        if len(word) > ENDLESS:
            text = word.decode("utf-8", "surrogatepass")
            spaced = len(text) - len(UNSPACED.findall(text))
            total += spaced * (spaced > ENDLESS)
    return total


def numbered(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Each word as the number of its first appearance among distinct words."""
    known = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), len(known)


def repeated_words(ids: np.ndarray, distinct: int, window: int = 5) -> int:
    """Words inside windows of five that the text holds twice or more, the first included."""
    n = len(ids)
    if n <= window or distinct == n:
        return 0
    bits = distinct.bit_length()
    packed, width = ids, 1  # exact numbers of windows of `width` words
    while width < window:
        step = min(window - width, max(1, 62 // bits - 1))
        size = n - width - step + 1
        room = packed[:size]
        if int(room.max()).bit_length() + bits * step > 62:
            _, room = np.unique(room, return_inverse=True)
            step = min(step, max(1, (62 - n.bit_length()) // bits))
            size = n - width - step + 1
            room = room[:size] if size <= len(room) else np.unique(packed[:size], return_inverse=True)[1]
        for k in range(step):
            room = (room << bits) | ids[width + k:width + k + size]
        packed, width = room, width + step
    ordered = np.sort(packed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    often = np.isin(packed, twice)
    edges = np.zeros(n + 1, np.int64)
    edges[:n - window + 1] += often
    edges[window:] -= often
    return int((np.cumsum(edges[:n]) > 0).sum())


def folded(text: str | None) -> list[str]:
    """The words of a text as the lexicon has them: lower case, without marks at the ends."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()  # at ASCII white space only
    return [word.decode("utf-8", "surrogatepass").strip(_EDGES) for word in words]


def toxic_words(text: str | None, words: frozenset[str]) -> tuple[int, int]:
    """(words of the lexicon in a text, places where one closely follows another). Counts
    don't depend on the length of the rest."""
    if not words or not text:
        return 0, 0
    found = folded(text)
    if words.isdisjoint(found):
        return 0, 0
    at = [i for i, word in enumerate(found) if word in words]
    return len(at), sum(b - a < CLOSE for a, b in zip(at, at[1:]))


def learned_lexicon(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The toxic words of each language, from the labelled rows of ``docs``, at most ``TAUGHT`` documents.

    That bound keeps the labels small enough to be sent to the texts, which stay in place
    at any size. Collected are only the chosen words; each stands in a hundredth of its language's toxic
    documents, so their number doesn't grow with the corpus. Documents without language
    are taught as one, and rows whose ``toxic`` is null teach nothing.
    """
    @F.pandas_udf("array<string>")
    def distinct(texts: pd.Series) -> pd.Series:
        return pd.Series([list(dict.fromkeys(word for word in folded(t) if word)) for t in texts], dtype=object)

    row_batches(docs.sparkSession)
    judged_ = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
               .agg((F.max("toxic") == 1).alias("_toxic")))
    judged_ = written(judged_, "labels")
    share = TAUGHT / max(1, judged_.count())
    if share < 1:
        judged_ = judged_.filter(unit(F.xxhash64("_id")) < share)
    rows = docs.select("doc_id", "text", F.col("lang").alias("_lang")).join(
        F.broadcast(judged_), F.col("doc_id") == F.col("_id")).select("_lang", "_toxic", distinct("text").alias("_words"))
    # The empty word, which no text holds, counts the documents.
    counts = (rows.select("_lang", "_toxic", F.explode(F.concat(F.array(F.lit("")), "_words")).alias("_word"))
              .groupBy("_lang", "_word").agg(F.count(F.when(F.col("_toxic"), 1)).alias("_in"),
                                             F.count(F.when(~F.col("_toxic"), 1)).alias("_out")))
    counts = written(counts.filter(F.col("_in") >= MIN_DOCUMENTS), "lexicon")
    totals = counts.filter("_word = ''").select("_lang", F.col("_in").alias("_toxics"), F.col("_out").alias("_cleans"))
    chosen = join_nulls(counts.filter("_word <> ''"), totals, ["_lang"]).filter(
        (F.col("_in") >= MIN_SHARE * F.col("_toxics"))
        & (F.col("_in") * (F.col("_cleans") + 1) >= MIN_RATIO * (F.col("_out") + 0.5) * F.col("_toxics")))
    found: dict[str | None, set[str]] = {}
    for row in chosen.select("_lang", "_word").collect():
        found.setdefault(row["_lang"], set()).add(row["_word"])
    return {lang: frozenset(words) for lang, words in found.items()}


def measured(docs: DataFrame, text: str = "text", lexicon: Lexicon | None = None, lang: str = "lang") -> DataFrame:
    """All columns of ``docs`` and the measurements as a struct ``_measures``.

    Existing columns of that name are replaced. A lexicon asks for the column ``lang``; a
    text without language meets the words of all.
    """
    known = lexicon or {}
    every = frozenset().union(*known.values())

    @F.pandas_udf(SCHEMA)
    def measures(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        rows = [(*measure(t), *toxic_words(t, every if name is None else known.get(name, frozenset())))
                for t, name in zip(texts, langs)]
        return pd.DataFrame(np.array(rows, np.int64).reshape(-1, len(MEASURES + LEARNED)),
                            columns=list(MEASURES + LEARNED))
    return docs.withColumn("_measures", measures(F.col(text), F.col(lang) if known else F.lit(None).cast("string")))


def failures(measures: str = "_measures") -> Column:
    """The mask of failed rules from the measurements."""
    name = re.compile(r"\b(" + "|".join(MEASURES + LEARNED) + r")\b")
    mask = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES):
        condition = name.sub(rf"{measures}.\1", rule.fails)
        mask = mask + F.when(F.expr(condition), F.lit(1 << bit)).otherwise(0)
    return mask


def ledger(docs: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """One row per document row: doc_id, the measurements and the mask of failed rules.

    Without a lexicon no text fails the rule of toxic words.

    A null text counts as empty; it and a text without words have all measurements 0
    (symbols aside) and fail the length rule. Repeated rows each get their row. Extra
    columns are left out, so names can't clash. An empty table gives an empty ledger.
    """
    rows = measured(docs.select("doc_id", "text", *["lang"] * bool(lexicon)), lexicon=lexicon).withColumn("failed", failures())
    return rows.select("doc_id", *[F.col(f"_measures.{m}").alias(m) for m in MEASURES + LEARNED], "failed")


def judged(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """A ledger with ``base_failed`` and the verdict ``kept`` of a policy."""
    base = policy_mask(1)
    return entries.withColumns({
        "base_failed": F.col("failed").bitwiseAND(F.lit(base)) != 0,
        "kept": F.col("failed").bitwiseAND(F.lit(base | policy_mask(version))) == 0})


def ablation(entries: DataFrame, version: int = CURRENT) -> DataFrame:
    """Per rule of a policy: documents failing it, and those that no other rule would reject."""
    mask = policy_mask(version)
    counts = [(bit, rule.name) for bit, rule in enumerate(RULES) if mask >> bit & 1]
    inside = F.col("failed").bitwiseAND(F.lit(mask))
    total = entries.agg(*[F.count(F.when(inside.bitwiseAND(F.lit(1 << bit)) != 0, 1)).alias(f"f{bit}")
                          for bit, _ in counts],
                        *[F.count(F.when(inside == F.lit(1 << bit), 1)).alias(f"o{bit}")
                          for bit, _ in counts])
    return total.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"f{bit}").alias("failing"),
                 F.col(f"o{bit}").alias("only")) for bit, name in counts])).alias("r")).select("r.*")


def keep_good(docs: DataFrame, version: int = CURRENT, lexicon: Lexicon | None = None) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with their columns unchanged."""
    mask = policy_mask(1) | policy_mask(version)
    rows = measured(docs.select(F.struct("*").alias("_row"), "text", *["lang"] * bool(lexicon)), lexicon=lexicon)
    return rows.filter(failures().bitwiseAND(F.lit(mask)) == 0).select("_row.*")
