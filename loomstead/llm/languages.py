"""The language of each text and of each passage: cleaned labels, character models trained on a bounded labelled sample,
the lowest cross-entropy per character, and rejection calibrated on held-out sentences, of the languages and of languages left out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstead.llm.charlm import CharModels, plain

#: Labelled rows per language that the models are fitted on; the least to fit a language at all.
TRAIN_ROWS, LEAST_ROWS = 400, 5
#: Labels, those with the most rows, that may become models; ISO 639-1 has 184 codes.
MOST_LABELS = 250
#: Odds (natural logarithm, after calibration) and letters of a sentence that shows a further language; letters of a row.
SURE, LEAST_SENTENCE, LEAST_LETTERS = 6.0, 12, 15
#: Share of sentences expected to be of none of the languages; the limit of rejection makes the fewest errors at that share.
FOREIGN = 0.01

# fixed values: spellings of the languages (ISO 639-1, 639-2 and 639-3 codes, names)
NAMES = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "cmn", "chinese", "中文", "mandarin"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "español", "castellano"),
    "fr": ("fr", "fra", "fre", "french", "français"),
    "pt": ("pt", "por", "portuguese", "português"),
    "ru": ("ru", "rus", "russian", "русский"),
    "ja": ("ja", "jpn", "japanese", "日本語"),
}
# fixed values: labels that name no language
NO_LANGUAGE = ("", "unknown", "und", "undetermined", "n/a", "na", "none", "null", "nan", "mul", "mis", "zxx", "xx", "other", "auto", "?", "-")


def label_code(column: Column) -> Column:
    """The ISO 639-1 code a label names; null if it names none; the label itself, lower-cased, for other languages."""
    base = F.substr(F.lower(F.trim(column)), F.lit(1), F.lit(64))  # no label is longer
    base = F.regexp_extract(base, r"^([^\s_.@]+?)(?:[-_.@][a-z0-9]+)*$", 1)
    base = F.when(F.lower(F.trim(column)).isin(*NO_LANGUAGE), "").otherwise(base)
    out = F.when(base.isin(*NO_LANGUAGE), F.lit(None))
    for code, names in NAMES.items():
        out = out.when(base.isin(*names), code)
    return out.otherwise(base)


_FENCE = re.compile(r"^[\s>​-‏﻿]*(```|~~~)")
_QUOTE = re.compile(r"^[\s>​-‏﻿]+")
_COMMENT = re.compile(r"<!--|-->")
_TAG = re.compile(r"<[^<>\n]{1,80}>")
_CODE = re.compile(r"`[^`\n]*`")
_STOP = re.compile(r"(?<=[.!?…])(?=\s)|(?<=[。！？｡])")
_HEADING = re.compile(r"^(?:#{1,6}\s|\*\*[^*]+\*\*:?$|__[^_]+__:?$|[=\-_*]{3,}$)")
_BULLET = re.compile(r"^(?:[-*+•]|\d+[.)])\s+")
_LOG = re.compile(r"^(?:error|warning|note|help|info|debug|trace|panic|thread)\b[^ ]*[:\[]|^-->|^at \S+\(|^\s*\||^[\[{(]?\d{4}-\d\d-\d\d|^[A-Za-z_-]+: \S+$|^[\w-]+ ?= ?[\[\"{]|^cc @|^\$ ", re.I)
_END = re.compile(r"[.!?…。！？｡][)\]\"'»”’`*_]*$")
# what makes a sentence one of links, names or personal data
_DATA = re.compile(r"https?:|www\.|\S@\S|\(at\)|\[at\]|(?<!\w)@\w|sha\d+:|\d[\d .()/-]{7,}\d|\d{4,}|\b(?:Dr|Mr|Mrs|Ms|Prof|Herr|Frau|Mme|Sra?)\.? [A-Z]|(?:(?<=[a-z:,] )|^(?=\S+ (?:[A-Z]\. )?\S+$))[A-Z][a-z]+,? (?:[A-Z]\. )?[A-Z][a-z]+(?:-[A-Z][a-z]+)?(?=[\s,.;:)]|$)")
_IDENT = re.compile(r"\S*(?:::|_|->|=>|\(\)|[A-Za-z0-9]-[A-Za-z0-9]|[a-z][A-Z]|\.[A-Za-z]|\d)\S*|\S*[/\\]\S*")
_LETTER = re.compile(r"[^\W\d_]")


def sentences(text: str | None, titled: bool) -> list[tuple[str, str, bool | None]]:
    """(as written, plain, whole) of the sentences of prose in a text; with ``titled``, its first line is a title.

    Code, logs, headings, bare links and lists of fragments are left out. ``whole`` is false for a sentence without an
    end, and for one about links, names or personal data: such a sentence doesn't show a further language.
    """
    out, fenced, first = [], False, True
    for line in _COMMENT.sub("\n", text or "").replace("\r", "\n").split("\n"):
        if _FENCE.match(line):
            fenced = not fenced
            continue
        line = _QUOTE.sub("", line).strip()
        if fenced or not line:
            continue
        title, first = titled and first, False
        if _HEADING.match(line) or _LOG.match(line) or (line.endswith(":") and len(line) < 40):
            continue
        item = _BULLET.match(line)
        line = line[item.end() :] if item else line
        for part in _STOP.split(line):
            part = part.strip()
            if not part:
                continue
            words = _IDENT.sub(" ", _TAG.sub(" ", _CODE.sub(" ", part)))
            p = plain(words)
            if len(p) < 7:
                continue
            whole = None if _DATA.search(part) else title or bool(_END.search(part))
            if item and not _END.search(part):
                continue
            out.append((part, p, whole))
    return out


def joint_votes(labelled: list[tuple[str, list[str]]], names: list[str]) -> list[list[bool]]:
    """Whether each sentence's runs of three characters are most at home in its own label, by their share of all its other runs.

    Unlike the conditional models, these shares aren't fooled by a few rows of another language under a wrong label.
    """
    def codes(text: str) -> np.ndarray:
        c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]

    coded = [[codes(s) for s in ss] for _, ss in labelled]
    keys = np.unique(np.concatenate([x for c in coded for x in c]))
    count = np.full((len(keys), len(names)), 0.05)
    for (l, _), c in zip(labelled, coded):
        for x in c:
            np.add.at(count[:, names.index(l)], np.searchsorted(keys, x), 1)
    total = count.sum(axis=0)
    share = np.log(count / total)

    def own(x: np.ndarray, k: int) -> bool:
        at, n = np.unique(np.searchsorted(keys, x), return_counts=True)
        scores = n @ share[at]
        scores[k] = n @ np.log((count[at, k] - n) / max(total[k] - len(x), 1.0))  # without itself
        return int(scores.argmax()) == k

    return [[own(x, names.index(l)) for x in c] for (l, _), c in zip(labelled, coded)]


class Identifier:
    """Models, the temperature of the odds, and the limit of cross-entropy up to which a sentence is of one of the languages.

    All are fitted on labelled sentences. A label is a language if most of its sentences are at home in it, so labels
    that only stand on texts of other languages get no model.
    """

    def __init__(self, labelled: list[tuple[str, list[str]]]):
        names = sorted({l for l, _ in labelled})
        votes = joint_votes(labelled, names)  # some labels are wrong, and some texts mixed
        told = {l: [0, 0] for l in names}
        for (l, ss), v in zip(labelled, votes):
            told[l][0] += sum(v)
            told[l][1] += len(v)
        names = [l for l in names if 2 * told[l][0] > told[l][1]] or names
        kept = [(l, [s for s, ok in zip(ss, v) if ok]) for (l, ss), v in zip(labelled, votes) if l in names]
        seen: dict[str, int] = {}
        train: dict[str, list[str]] = {l: [] for l in names}
        held = []
        for l, ss in kept:
            seen[l] = seen.get(l, 0) + bool(ss)
            if seen[l] % 5 == 0:
                held += [(l, s) for s in ss]
            else:
                train[l] += ss
        names = [l for l in names if train[l]]
        self.models = CharModels({l: train[l] for l in names})
        self.languages = self.models.languages
        self.temperature, self.limit, self.held_accuracy, self.held_rejected, self.foreign_accepted = 1.0, np.inf, 0.0, 0.0, 1.0
        self.mean, self.spread = np.full(len(names), np.inf), np.zeros(len(names))
        held = [x for x in held if x[0] in names]
        if held:
            self._calibrate([names.index(l) for l, _ in held], [s for _, s in held])

    def _calibrate(self, truth: list[int], sentences: list[str]) -> None:
        total, size = self.models.scores(sentences)
        truth, rows = np.array(truth), np.arange(len(sentences))
        best = total.argmax(axis=1)
        grid = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0)
        loss = []
        for t in grid:
            z = t * (total - total.max(axis=1, keepdims=True))
            loss.append(float((np.log(np.exp(z).sum(axis=1)) - z[rows, truth]).mean()))
        self.temperature = grid[int(np.argmin(loss))]
        self.held_accuracy = float((best == truth).mean())
        entropy = -total / size[:, None]
        for k in range(total.shape[1]):
            own = entropy[(best == k) & (truth == k), k]
            if len(own) >= 20:
                self.mean[k], self.spread[k] = own.mean(), own.std()
        # a sentence whose own language is left out stands for one of a language without a model
        without = total.copy()
        without[rows, truth] = -np.inf
        other = without.argmax(axis=1)
        own = self._excess(entropy[rows, best], best, size)
        foreign = self._excess(entropy[rows, other], other, size) if total.shape[1] > 1 else np.empty(0)
        own, foreign = np.sort(own[np.isfinite(own)]), np.sort(foreign[np.isfinite(foreign)])
        if len(own) and len(foreign):
            limits = np.append(own, own[-1] + 1.0)  # the last limit rejects none of them
            rejected = 1 - np.searchsorted(own, limits, "right") / len(own)
            accepted = np.searchsorted(foreign, limits, "right") / len(foreign)
            k = int(np.argmin((1 - FOREIGN) * rejected + FOREIGN * accepted))
            self.limit, self.held_rejected, self.foreign_accepted = float(limits[k]), float(rejected[k]), float(accepted[k])

    def _excess(self, entropy: np.ndarray, language: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Standard deviations above the mean cross-entropy of the language; short sentences vary more."""
        spread = self.spread[language] * np.sqrt(np.maximum(1.0, 50 / size))
        return np.where(spread > 0, (entropy - np.where(spread > 0, self.mean[language], 0.0)) / np.where(spread > 0, spread, 1.0), -np.inf)

    def classify(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per plain sentence the language's number (-1: none of them), its log odds and its confidence."""
        if not texts:
            return np.empty(0, int), np.empty(0), np.empty(0)
        total, size = self.models.scores(texts)
        best = total.argmax(axis=1)
        top = total[np.arange(len(total)), best]
        rest = total.copy()
        rest[np.arange(len(total)), best] = -np.inf
        odds = (top - rest.max(axis=1)) if total.shape[1] > 1 else np.full(len(top), 99.0)
        z = self.temperature * (total - top[:, None])
        confidence = 1 / np.exp(z).sum(axis=1)
        reject = self._excess(-top / size, best, size) > self.limit
        return np.where(reject, -1, best), self.temperature * odds, confidence


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Identifier | None:
    """Fit on at most ``train_rows`` labelled rows per language of rows (id, text, label, titled): those of the lowest hashes.

    All labels with LEAST_ROWS rows take part, also of languages that NAMES doesn't list. None if there is no such label.
    """
    known = rows.where(F.col("label").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("id", F.lit("train")))
    per_label = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
    counts = {r["label"]: r["n"] for r in per_label.orderBy(F.desc("n"), "label").limit(MOST_LABELS).collect()}
    below = F.lit(False)
    for label, n in counts.items():
        share = min(1.0, 1.5 * train_rows / n)
        below = below | ((F.col("label") == label) & (F.col("h") <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))))
    sample: dict[str, dict] = {}
    for r in known.where(below).select("id", "label", "text", "titled", "h").collect():
        sample.setdefault(r["label"], {})[r["id"]] = (r["h"], r["text"], r["titled"])
    labelled = []
    for label in sorted(sample):
        if len(sample[label]) >= LEAST_ROWS:
            for _, text, titled in sorted(sample[label].values(), key=lambda x: x[0])[:train_rows]:
                if s := [p for _, p, whole in sentences(text, titled) if whole is not None]:
                    labelled.append((label, s))
    return Identifier(labelled) if labelled else None


def _sets(spark, identifier: Identifier):
    return spark.sparkContext.broadcast(identifier)


SEGMENTS = "id long, label string, seq int, passage string, language string, confidence double"
ROWS = "id long, label string, n_letters int, language string, confidence double, share double, whole boolean"


def segments(rows: DataFrame, identifier: Identifier) -> DataFrame:
    """(id, label, seq, passage, language, confidence): neighbouring sentences of one language make a passage.

    Sentences of none of the languages have language ``und``. Null, empty and codes-only texts have no passages.
    """
    shared = _sets(rows.sparkSession, identifier)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                pdf = whole.iloc[lo : lo + 1024]
                parts = [sentences(t, bool(f)) for t, f in zip(pdf["text"], pdf["titled"])]
                lang, _, conf = m.classify([p for s in parts for _, p, _ in s])
                out, k = [], 0
                for i, label, s in zip(pdf["id"], pdf["label"], parts):
                    seq, last = 0, None
                    for written, p, _ in s:
                        name = m.languages[lang[k]] if lang[k] >= 0 else "und"
                        if last and last[4] == name:
                            n, w = len(p), len(last[6])
                            last[5] = (last[5] * w + conf[k] * n) / (w + n)
                            last[3] += " " + written
                            last[6] += p
                        else:
                            seq += 1
                            last = [i, label, seq, written, name, conf[k], p]
                            out.append(last)
                        k += 1
                yield pd.DataFrame([x[:6] for x in out], columns=["id", "label", "seq", "passage", "language", "confidence"])

    return rows.select("id", "label", "text", "titled").mapInPandas(run, SEGMENTS)


def row_languages(rows: DataFrame, identifier: Identifier) -> DataFrame:
    """(id, label, n_letters, language, confidence, share, whole): the languages of each row's prose, the main one first.

    ``share`` is the language's share of the prose, ``whole`` whether a whole sentence or title shows it beyond doubt.
    """
    shared = _sets(rows.sparkSession, identifier)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for whole in batches:
            for lo in range(0, len(whole), 1024):
                pdf = whole.iloc[lo : lo + 1024]
                parts = [sentences(t, bool(f)) for t, f in zip(pdf["text"], pdf["titled"])]
                lang, odds, conf = m.classify([p for s in parts for _, p, _ in s])
                out, k = [], 0
                for i, label, text, s in zip(pdf["id"], pdf["label"], pdf["text"], parts):
                    mass: dict[int, list] = {}
                    for _, p, complete in s:
                        if lang[k] >= 0 and complete is not None:
                            n = len(p) - 2 - p.count(" ") + 2
                            x = mass.setdefault(int(lang[k]), [0, 0.0, False])
                            x[0] += n
                            x[1] += n * conf[k]
                            cjk = m.languages[lang[k]] in ("zh", "ja")
                            x[2] |= bool(complete and odds[k] >= SURE and n >= (LEAST_SENTENCE // 2 if cjk else LEAST_SENTENCE))
                        k += 1
                    total = sum(x[0] for x in mass.values())
                    if total:
                        letters = len(_LETTER.findall(text))
                        for l, (n, c, w) in sorted(mass.items(), key=lambda x: -x[1][0]):
                            out.append((i, label, letters, m.languages[l], c / n, n / total, w))
                yield pd.DataFrame(out, columns=["id", "label", "n_letters", "language", "confidence", "share", "whole"])

    return rows.select("id", "label", "text", "titled").mapInPandas(run, ROWS)


def found(languages: DataFrame) -> DataFrame:
    """(id, language) of the rows whose label is missing, names another language than the main one, or covers only part.

    A row shows the languages of its whole sentences, or its main one without any. Rows with fewer than LEAST_LETTERS
    letters, without prose, or with the right label for all of it are left out.
    """
    per = languages.groupBy("id").agg(
        F.first("label").alias("label"),
        F.max("n_letters").alias("n_letters"),
        F.max(F.struct("share", "language")).alias("top"),
        F.collect_set(F.when(F.col("whole"), F.col("language"))).alias("wholes"),
    )
    main = F.col("top.language")
    case = F.col("label").isNull() | (F.col("label") != main) | (F.size("wholes") > 1)
    names = F.when(F.size("wholes") > 0, F.col("wholes")).otherwise(F.array(main))
    return per.where(case & (F.col("n_letters") >= LEAST_LETTERS)).select("id", F.explode(names).alias("language"))
