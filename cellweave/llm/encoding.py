"""Find text that was decoded with the wrong character encoding and restore it.

A multinomial naive Bayes classifier over hashed byte bigrams tells clean text from text garbled by
each of a list of encoding chains. It is trained on records of the corpus itself, garbled on
purpose by every chain. A stretch is held to be garbled when the classifier names a chain, the chain
can be undone strictly, without a byte that doesn't decode, and what comes out looks clean. Garbled text
that was then written as character references (`&#195;&#169;`, `&#xC3;`, `&Atilde;`) is read through
its references: each chain is also undone with the references as its last step.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.entities import html5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The chains, each a list of steps (encoding written, encoding read).
CHAINS: dict[str, list[tuple[str, str]]] = {
    "utf8>latin1": [("utf-8", "latin-1")],
    "utf8>cp1252": [("utf-8", "cp1252")],
    "utf8>latin1 twice": [("utf-8", "latin-1"), ("utf-8", "latin-1")],
    "utf8>cp1252 twice": [("utf-8", "cp1252"), ("utf-8", "cp1252")],
    "utf8>cp850": [("utf-8", "cp850")],
    "utf8>cp437": [("utf-8", "cp437")],
    "utf8>mac_roman": [("utf-8", "mac_roman")],
    "utf8>cp1251": [("utf-8", "cp1251")],
    "utf8>koi8_r": [("utf-8", "koi8_r")],
    "cp1251>cp1252": [("cp1251", "cp1252")],
    "cp1252>cp1251": [("cp1252", "cp1251")],
    "koi8_r>cp1251": [("koi8_r", "cp1251")],
    "cp1251>koi8_r": [("cp1251", "koi8_r")],
}
# Chains of which bytes or case are lost.
LOWERED = {"utf8>latin1 lowered": "utf8>latin1", "utf8>cp1252 lowered": "utf8>cp1252"}
LOST = {"cp1252>utf8 lost": "cp1252", "cp1251>utf8 lost": "cp1251"}
CLEAN = "clean"
LABELS = [CLEAN, *CHAINS, *LOWERED, *LOST]
LOST_MARK = "\N{REPLACEMENT CHARACTER}"

#: Added to the name of a chain whose result was written as character references.
REFERENCES = ">references"

_UNITS = r"(?<=[.!?] )|(?<=\n)"
_REFERENCE = re.compile(r"&(?:#([0-9]+)|#[xX]([0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*));")
# What `unescape` may turn into a character beyond ASCII, and such characters themselves; names of HTML are looked up later.
_BEYOND = (
    r"[^\x00-\x7f]|&#0*(?:12[89]|1[3-9][0-9]|[2-9][0-9]{2}|[1-9][0-9]{3,6});|&#[xX]0*(?:[89a-fA-F][0-9a-fA-F]|[1-9a-fA-F][0-9a-fA-F]{2,5});"
    r"|&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z][A-Za-z0-9]*;"
)


def _character(match: re.Match) -> str:
    """The character beyond ASCII that a reference stands for; other references stay as they are."""
    decimal, hexadecimal, name = match.groups()
    if name:
        out = html5.get(name + ";", "")
    else:
        digits = (decimal or hexadecimal).lstrip("0")
        number = int(digits or "0", 10 if decimal else 16) if len(digits) < 8 else -1
        out = chr(number) if 0x80 <= number < 0xD800 or 0xE000 <= number < 0x110000 else ""
    return match[0] if out.isascii() else out


def unescape(text: str) -> str:
    """`text` with its references to characters beyond ASCII replaced by these."""
    return _REFERENCE.sub(_character, text) if "&" in text else text


def escape(text: str) -> str:
    """`text` with its characters beyond ASCII written as numeric references."""
    return text.encode("ascii", "xmlcharrefreplace").decode("ascii")


def _undefined(error: UnicodeError):
    """Bytes a code page leaves undefined stand for the control characters of the same number."""
    if isinstance(error, UnicodeDecodeError):
        return chr(error.object[error.start]), error.start + 1
    if isinstance(error, UnicodeEncodeError) and 0x80 <= ord(error.object[error.start]) < 0xA0:
        return bytes([ord(error.object[error.start])]), error.start + 1
    raise error


def _page(codec: str) -> str:
    codecs.register_error("undefined", _undefined)
    return "strict" if codec == "utf-8" else "undefined"


def garble(text: str, label: str) -> str | None:
    """`text` as the chain leaves it; None where the chain can't have happened to it."""
    try:
        if label in LOST:
            out = text.encode(LOST[label]).decode("utf-8", "replace")
            return out if LOST_MARK in out else None
        out = text
        for written, read in CHAINS[LOWERED.get(label, label)]:
            out = out.encode(written).decode(read, _page(read))
    except UnicodeError:
        return None
    if label in LOWERED:
        if out.lower() == out:
            return None
        out = out.lower()
    return out if out != text else None


def ungarble(text: str, label: str) -> str | None:
    """What `text`, read through its references, was before the chain; None if it can't be undone strictly or nothing changes."""
    text = unescape(text)
    if label in LOWERED:
        text, label = _raise_leads(text), LOWERED[label]
    if label not in CHAINS:
        return None
    out = text
    try:
        for written, read in reversed(CHAINS[label]):
            out = out.encode(read, _page(read)).decode(written)
    except UnicodeError:
        return None
    return out if out != text else None


def _raise_leads(text: str) -> str:
    """Upper case again for letters that stand where the first byte of a character must."""
    out = list(text)
    for i in range(len(out) - 1):
        follows = "\x80" <= out[i + 1] <= "\xbf" or out[i + 1] in _CP1252_CONTROLS
        if follows and "\xe0" <= out[i] <= "\xe3" or follows and out[i] in "\xe5\xf0\xf1":
            three = i + 2 < len(out) and ("\x80" <= out[i + 2] <= "\xbf" or out[i + 2] in _CP1252_CONTROLS)
            # Of these only E2 itself opens a character of three bytes here; C2, C3, C5, D0 and D1 open two.
            out[i] = out[i] if out[i] == "\xe2" and three else out[i].upper()
    return "".join(out)


# The characters that code page 1252 has for bytes 80 to 9F.
_CP1252_CONTROLS = frozenset("€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ")


def _bigrams(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte bigrams that touch a byte over 127, and the text each is of."""
    raw = [b" " + t.encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    who = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    a, b = data[:-1], data[1:]
    high = (a >= 128) | (b >= 128)
    code = (a * 256 + b)[high]
    return ((code * 2654435761) >> 7) % width, who[:-1][high]


@dataclass
class Model:
    """Log probabilities of the bigrams by label."""

    weights: np.ndarray
    prior: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, records: np.ndarray, alpha: float) -> Model:
        smooth = counts + alpha
        # A label without records is never named.
        prior = np.where(records > 0, 0.0, -1e18)
        return cls(np.log(smooth / smooth.sum(1, keepdims=True)), prior)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.tile(self.prior, (len(texts), 1))
        if texts:
            at, who = _bigrams(texts, self.weights.shape[1])
            for label, weights in enumerate(self.weights):
                out[:, label] += np.bincount(who, weights[at], minlength=len(texts))
        return out


def _labelled(model: Model | None):
    """Units and what each chain makes of them: rows of label and bigram."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t for t in map(unescape, batch["unit"]) if not t.isascii()]
            if model:
                best = model.scores(texts).argmax(1)
                texts = [t for t, label in zip(texts, best) if label == 0]
            labels, made = [0] * len(texts), list(texts)
            for label, name in enumerate(LABELS[1:], 1):
                out = [g for g in (garble(t, name) for t in texts) if g]
                made += out
                labels += [label] * len(out)
            if not made:
                continue
            at, who = _bigrams(made, WIDTH)
            rows = pd.DataFrame({"label": np.asarray(labels)[who], "bigram": at})
            counted = rows.groupby(["label", "bigram"]).size().rename("n").reset_index()
            whole = pd.Series(labels).value_counts()
            yield pd.concat([counted, pd.DataFrame({"label": whole.index, "bigram": -1, "n": whole.to_numpy()})])

    return run


#: Units gathered for each that the sample keeps.
_SPARE = 2

#: Hash buckets of the bigrams.
WIDTH = 1 << 14


def train(df: DataFrame, text: str, rows: int = 20_000, alpha: float = 0.05) -> Model:
    """Fit the classifier on at most `rows` units (sentences or lines) with a character beyond ASCII.

    References to such characters count as the characters: a chain looks the same with and without
    them as its last step. The units are those with the smallest hashes, of the whole table. They are taken as clean at
    first; those that the first fit finds garbled are left out of the second. The model has
    len(LABELS) * WIDTH numbers. Without such units every text counts as clean.
    """
    units = _units(df.select(F.col(text).alias("text")), "text").select("unit")
    # Of about `_SPARE * rows` units with the smallest hashes, which are evenly spread, the smallest `rows` are taken: what is
    # brought together doesn't grow with the table.
    hashed = units.withColumn("_h", F.xxhash64("unit"))
    distinct = hashed.agg(F.approx_count_distinct("_h")).first()[0]
    share = _SPARE * rows / max(distinct, 1)
    if share < 1:
        hashed = hashed.filter(F.col("_h") < F.lit(int((share - 0.5) * 2.0**64)))
    sample = hashed.distinct().orderBy("_h", "unit").limit(rows).select("unit")
    sample = sample.repartition(df.sparkSession.sparkContext.defaultParallelism).persist()
    model = None
    for _ in range(2):
        found = sample.mapInPandas(_labelled(model), "label int, bigram int, n long")
        total = found.groupBy("label", "bigram").agg(F.sum("n").alias("n")).toPandas()
        counts, records = np.zeros((len(LABELS), WIDTH)), np.zeros(len(LABELS))
        whole, part = total[total["bigram"] < 0], total[total["bigram"] >= 0]
        records[whole["label"]] = whole["n"]
        counts[part["label"], part["bigram"]] = part["n"]
        records[0] = max(records[0], 1)
        model = Model.of(counts, records, alpha)
    sample.unpersist()
    return model


def _units(df: DataFrame, text: str) -> DataFrame:
    """`unit`: the sentences and lines of the texts that hold a character beyond ASCII or a reference to one, separators kept."""
    rows = df.filter(F.col(text).rlike(_BEYOND))
    return rows.withColumn("unit", F.explode(F.split(F.col(text), _UNITS))).filter(F.col("unit").rlike(_BEYOND))


def _named(scores: np.ndarray, margin: float) -> bool:
    """Whether a chain is named clearly enough. Any text decodes strictly under a one-byte page, so that
    chains between such pages, which that doesn't verify, need three times the margin."""
    best = int(scores.argmax())
    return best != 0 and scores[best] - scores[0] >= margin * (3 if _between_pages(LABELS[best]) else 1)


def _between_pages(label: str) -> bool:
    return label in CHAINS and all("utf-8" not in step for step in CHAINS[label])


def _tail(text: str) -> str:
    return REFERENCES if unescape(text) != text else ""


def _restore(unit: str, scores: np.ndarray, model: Model, margin: float) -> tuple[str | None, str]:
    """The unit restored and the chain, by the likeliest of the chains that score above clean and can be undone; (None, "") if none can."""
    for label in np.argsort(-scores):
        name = LABELS[label]
        if label == 0 or scores[label] <= scores[0]:
            break
        if name in LOST:
            if LOST_MARK in unescape(unit):
                return None, name + _tail(unit)
            continue
        whole = ungarble(unit, name)
        tail = _tail(unit)
        if whole is None:
            # The stretch is a part of the unit: undo it word by word.
            words = unit.split(" ")
            undone = [ungarble(w, name) for w in words]
            if any(undone):
                whole = " ".join(u or w for u, w in zip(undone, words))
                tail = _tail(" ".join(w for u, w in zip(undone, words) if u))
        if whole is None:
            continue
        after = model.scores([unescape(whole)])[0]
        # A word in capitals may still look odd once it is right; a chain of UTF-8 that it went through strictly is evidence enough.
        eased = " " not in unit.strip() and not _between_pages(name) and after.max() - after[0] <= (scores.max() - scores[0]) / 2
        if eased or not _named(after, margin):
            return whole, name + tail
    return None, ""


def _suspects(words: list[str], model: Model, margin: float) -> dict[str, np.ndarray]:
    """The words that a chain is named for, with their scores; each distinct word is scored once."""
    odd = sorted({w for w in words if not unescape(w).isascii()})
    return {w: s for w, s in zip(odd, model.scores([unescape(w) for w in odd])) if _named(s, margin)}


def _repair(units: list[str], scores: list[np.ndarray | None], model: Model, margin: float, suspects: dict[str, np.ndarray] | None) -> tuple[str, list[str], bool]:
    """The text with its garbled units restored, the chains, and whether all of them could be restored.

    `scores` has the scores of the units that a chain is named for, None for the others; `suspects` those of their words,
    where they were gathered before.
    """
    chains: list[str] = []
    whole = True
    out = []
    for unit, own in zip(units, scores):
        if unescape(unit).isascii():
            out.append(unit)
            continue
        if own is not None:
            restored, chain = _restore(unit, own, model, margin)
            if chain:
                chains.append(chain)
                whole &= restored is not None
                out.append(unit if restored is None else restored)
                continue
        words = unit.split(" ")
        bad = suspects if suspects is not None and own is None else _suspects(words, model, margin)
        for i, word in enumerate(words):
            if word in bad:
                restored, chain = _restore(word, bad[word], model, margin)
                if chain:
                    chains.append(chain)
                    whole &= restored is not None
                    words[i] = word if restored is None else restored
        out.append(" ".join(words))
    return "".join(out), chains, whole


def _repair_all(texts: list[str], model: Model, margin: float) -> Iterator[tuple[str, list[str], bool]]:
    """`_repair` of each text, with the units and then the words of all texts scored together."""
    parts = [re.split(_UNITS, t) for t in texts]
    odd = sorted({u for units in parts for u in units if not unescape(u).isascii()})
    named = {u: s for u, s in zip(odd, model.scores([unescape(u) for u in odd])) if _named(s, margin)}
    suspects = _suspects([w for u in odd if u not in named for w in u.split(" ")], model, margin)
    for units in parts:
        yield _repair(units, [named.get(u) for u in units], model, margin, suspects)


def repair_encoding(df: DataFrame, key: str, text: str, model: Model, margin: float = 4.0) -> DataFrame:
    """key, chains STRING, restored STRING, complete BOOLEAN: the records whose text is garbled somewhere.

    `chains` lists the chains met, sorted and joined by "; ". `restored` is the whole text with
    every stretch restored that can be, NULL if none can; `complete` tells whether all could.
    NULL, empty and plain ASCII texts without references to other characters are never affected, and
    references to characters that were decoded rightly stay as they are. Texts are treated whole, of any length;
    repeated rows give repeated results.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # len(LABELS) * WIDTH numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            rows = [
                (key_value, "; ".join(sorted(set(chains))), fixed if fixed != t else None, whole)
                for key_value, t, (fixed, chains, whole) in zip(batch["key"], texts, _repair_all(texts, shared.value, margin))
                if chains
            ]
            yield pd.DataFrame(rows, columns=["key", "chains", "restored", "complete"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").rlike(_BEYOND))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInPandas(run, f"key {kind}, chains string, restored string, complete boolean")
