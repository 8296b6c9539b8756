"""Personal information in free text: candidates by shape, judged by contexts that seed entities bootstrap.

A candidate has a kind, instances (an e-mail's domain, the words before an identity number, a phone number's shape, a street's type, a given and a family name)
and two patterns: the words before it and after it. Seeds are candidates that are certain by themselves. A pattern's
confidence is the share of its candidates that are seeds or have trusted instances; an instance's is the share of its
candidates that are seeds or stand in trusted patterns. After ROUNDS rounds trusted patterns and instances decide.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstead.operators.joins import join_unique
from loomstead.sources.shared import Cuts

ROUNDS = 4
KINDS = ("email", "phone", "id_number", "address", "name")
#: Confidence from which a pattern or an instance is trusted, and uses it must have.
TRUSTED, LEAST_USES = 0.3, 3
#: Share of certain or trusted uses that makes a pattern or an instance fully trusted.
ENOUGH = 0.2

#: Letters and digits of the longest identity numbers in use, those of bank accounts (ISO 13616); a longer run is a list or a dump.
LONGEST_ID = 34

# fixed values: words of flats, and titles
FLATS = "Flat|Apt|Apartment|Unit|Suite|Room"
TITLES = "Dr|Prof|Mr|Mrs|Ms|Miss|Herr|Frau|Mme|Mlle|Sr|Sra|Dra"
ID_SEEDS = ("ssn", "passport")

_HIDDEN = re.compile("[​‌‍⁠﻿]")
_AT = r"(?:\s?[(\[{]\s?at\s?[)\]}]\s?|@)"
_DOT = r"(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)"
_EMAIL = re.compile(rf"(?<![\w.+%@/-])([A-Za-z0-9][\w.+%-]*){_AT}((?:[A-Za-z0-9-]+{_DOT})+[A-Za-z]{{2,}})(?![\w@-])(?![:/][\w~/])", re.I)
_LINK = re.compile(r"(?:https?|ssh|git|ftp)://\S+|\S+@[\w.-]+:\S+|www\.\S+")
_PHONE = re.compile(r"(?<![\w.:/@#+-])(?:\+ ?|\()?\d(?:[\d().\-/]|[  ](?=[\d(]))*\d(?: ?(?:ext\.?|x|доб\.?) ?\d{1,6})?(?![\w@]|[.:-]\d)", re.I)
_ID = re.compile(r"(?<![\w.@/#+-])(?:(?!(?:ID|NO|NR|SSN|TEL)\b)[A-Z]{1,2} ?|[A-Z]{1,3}-?)?\d+(?:[ -]?\d+)*(?:[ -]?[A-Z]{1,2})?(?![\w@]|[.:-]\d)")
_CITY = r"[A-ZÄÖÜ][^\W\d_]+"
_PLACE = rf"(?:,[ ]?{_CITY}(?: \d{{5}})?|,?[ ]?\n[ \t>]*{_CITY} \d{{5}}|, ?\d{{5}} {_CITY}|,?[ ]?\n[ \t>]*\d{{5}} {_CITY})"
_FLAT = rf"(?:{FLATS})\.? \d+[A-Za-z]?"
_ADDRESS = re.compile(
    rf"(?<![\w@/.-])(?:"
    rf"(?:{_FLAT},?[ \n])?\d{{1,5}}[A-Za-z]? (?:[A-Z][^\W\d_]+ ){{1,2}}(?P<type>[A-Z][^\W\d_]+)\b\.?(?:,?[ \n]{_FLAT})?{_PLACE}?"
    rf"|(?P<box>P\. ?O\. ?Box|PO Box|Postfach) \d+{_PLACE}?"
    rf"|(?P<word>{_CITY}\.?)[ \xa0]\d{{1,4}}[a-z]?{_PLACE}?"
    rf")(?!\w)"
)
_CAP = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:['’][A-Z]?[a-z]+)?(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)*"
_TITLED = re.compile(rf"(?<![\w@/.-])(?:{TITLES})\.? (?:({_CAP}) (?:[A-Z]\. )?)?({_CAP})(?![\w@/])")
_NAME = re.compile(rf"(?<![\w@/.`-])(?=({_CAP}) (?:[A-Z]\. ?)?({_CAP})(?![\w@/]))")
_REVERSED = re.compile(rf"(?<![\w@/.`-])(?=({_CAP}), ({_CAP})(?: [A-Z]\.)?(?![\w@/]))")
_NAME_END = re.compile(rf"{_CAP}(?:,)? (?:[A-Z]\. ?)?{_CAP}(?: [A-Z]\.(?![a-z]))?")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[^\w\s]")
_SENTENCE = re.compile(r"[.!?。！？\n](?=\s|$)|\n|。")
# fixed values: marks of lists, quotes and markup that are no context
_NO_CONTEXT = set("<>\"'`*-_#([{)]}|")


def normalise(text: str) -> str:
    """NFKC, no invisible characters, LF line ends; comments and code stay."""
    text = text if text.isascii() else _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    return text.replace("\r\n", "\n").replace("\r", "\n")


def _left(text: str, at: int, n: int = 2) -> str | None:
    """The last n words before a place in its line; looks back as far as they take."""
    line, size = text.rfind("\n", 0, at) + 1, 80
    while True:
        start = max(line, at - size)
        w = [x for x in _WORD.findall(text[start:at].lower()) if x not in _NO_CONTEXT]
        if start == line or len(w) > n:  # the first one may be cut
            return " ".join(w[-n:]) or None
        size *= 4


def _sentences(text: str) -> list[int]:
    """Where sentences begin."""
    return [0] + [m.end() for m in _SENTENCE.finditer(text) if text[max(0, m.end() - 3) : m.end()].lower() != "no."]


def _head(text: str, at: int, begins: list[int]) -> str | None:
    """The first words of the sentence up to a place, if there are more of them."""
    w = [m[0] for m in itertools.islice(_WORD.finditer(text, begins[bisect.bisect_right(begins, at) - 1], at), 4)]
    return " ".join(w[:3]).lower() if len(w) > 3 else None


def _right(text: str, at: int, n: int = 2) -> str | None:
    """The first n words after a place in its line."""
    stop = text.find("\n", at)
    after = (m[0].lower() for m in _WORD.finditer(text, at, len(text) if stop < 0 else stop))
    return " ".join(itertools.islice((x for x in after if x not in _NO_CONTEXT), n)) or None


def _shape(s: str) -> str:
    return re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", s))


def mentions(text: str) -> list[tuple]:
    """Candidates of a normalised text: (kind, start, end, seed, instance, second instance, left, right)."""
    out: list[tuple] = []
    taken: list[tuple[int, int]] = []
    free = lambda a, b: not any(x < b and a < y for x, y in taken)
    has_digit, has_cap = any(map(str.isdigit, text)), not text.islower()
    if "@" in text or "at)" in text.lower() or "at]" in text.lower():
        for m in _EMAIL.finditer(text):
            start = m.start() - 7 if text[: m.start()].lower().endswith("mailto:") else m.start()
            if text[max(0, start - 3) : start] == "://" or not m[1].strip("."):
                continue
            domain = re.sub(r"\s?[(\[{]\s?dot\s?[)\]}]\s?", ".", m[2].lower())
            out.append(("email", start, m.end(), "@" in m[0], domain, None, _left(text, start), _right(text, m.end())))
            taken.append((start, m.end()))
    if "://" in text or "@" in text or "www." in text:
        for m in _LINK.finditer(text):
            if free(*m.span()):
                taken.append(m.span())
    if has_digit:
        for m in _ADDRESS.finditer(text):
            if not free(*m.span()):
                continue
            zipped = bool(re.search(r"\d{5} |\d{5}$", m[0][1:]) or re.search(rf"\b(?:{FLATS})\b", m[0]))
            # kinds of streets are induced: a word of their own in English, the end of a word in German
            kind_of = (m["type"] or (m["box"] and "box") or "-" + m["word"].rstrip(".")[-3:]).lower()
            seed = zipped or bool(m["box"])
            out.append(("address", *m.span(), seed, kind_of, None, _left(text, m.start()), None))
            if seed:
                taken.append(m.span())
        for m in _PHONE.finditer(text):
            if not free(*m.span()):
                continue
            main = re.split(r"(?i) ?(?:ext|x|доб)", m[0])[0]
            n = sum(map(str.isdigit, main))
            if not 9 <= n <= 15 or main.count("(") != main.count(")"):
                continue
            seed = (main.startswith("+") and n >= 10) or bool(re.fullmatch(r"\(\d{3}\) \d{3}-\d{4}", main))
            out.append(("phone", *m.span(), seed, _shape(main), None, _left(text, m.start()), _right(text, m.end())))
            if seed:
                taken.append(m.span())
        begins = _sentences(text)
        for m in _ID.finditer(text):
            if sum(map(str.isdigit, m[0])) < 6 or sum(map(str.isalnum, m[0])) > LONGEST_ID or not free(*m.span()):
                continue
            left = _left(text, m.start(), 3)
            seed = any(k in (left or "").split() for k in ID_SEEDS)
            frame = " | ".join((_head(text, m.start(), begins) or "?", _right(text, m.end(), 1) or "?"))
            out.append(("id_number", *m.span(), seed, _left(text, m.start()), None, None, frame))
    if has_cap:
        for m in _TITLED.finditer(text):
            if free(*m.span()):
                out.append(("name", *m.span(), True, m[1], m[2], _left(text, m.start()), _right(text, m.end())))
                taken.append(m.span())
        for pattern, given, family in ((_NAME, 1, 2), (_REVERSED, 2, 1)):
            for m in pattern.finditer(text):
                end = m.start() + len(_NAME_END.match(text, m.start())[0])
                if not free(m.start(), end):
                    continue
                mail = text[end : end + 2] == " <" and any(k == "email" and a <= end + 9 and a >= end for k, a, *_ in out)
                weak = ["", None][family == 2]  # a reversed name needs more than its context
                out.append(("name", m.start(), end, mail and weak is None, m[given], m[family], _left(text, m.start()) if weak is None else "~" + (_left(text, m.start()) or "^"), _right(text, end)))
    return out


CANDIDATES = "text_hash long, table_name string, record_id long, kind string, start int, stop int, seed boolean, inst string, inst2 string, l string, r string"


def candidates(rows: DataFrame) -> DataFrame:
    """Candidates of rows (table_name, record_id, text). Null and empty texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in CANDIDATES.split(", ")]
        for pdf in batches:
            out = []
            for t, i, text in zip(pdf["table_name"], pdf["record_id"], pdf["text"]):
                plain = normalise(text)
                if found := mentions(plain):
                    h = int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)
                    out += [(h, t, i, *m) for m in found]
            yield pd.DataFrame(out, columns=names)

    return rows.where("record_id is not null and text is not null").select("table_name", "record_id", "text").mapInPandas(run, CANDIDATES)


def bootstrap(found: DataFrame, cuts: Cuts, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Confidence of patterns (kind, side, p, pc) and of instances (kind, inst, ic), scored in turns over their graph.

    Without rounds nothing but seeds is trusted.
    The graph's edges are aggregated first: their number grows with the different patterns and instances, not the rows.
    Copies of a text count once, so no text weighs more for being delivered often.
    """
    once = found.dropDuplicates(["text_hash", "kind", "start", "stop"])
    edges = cuts.cut(once.groupBy("kind", "inst", "l", "r").agg(F.sum(F.col("seed").cast("int")).alias("s"), F.count(F.lit(1)).alias("n")), "edges")
    sides = F.explode(F.array(F.struct(F.lit("l").alias("side"), F.col("l").alias("p")), F.struct(F.lit("r").alias("side"), F.col("r").alias("p")))).alias("x")
    # shapes of numbers are shared with other numbers, so they don't make a pattern trusted
    open_kind = F.col("kind") != "phone"
    inst = cuts.cut(edges.groupBy("kind", "inst").agg(F.least(F.lit(1.0), F.sum("s") / (F.lit(ENOUGH) * (F.sum("n") + 1))).alias("ic")), "inst0")
    if not rounds:
        return edges.select("kind", F.lit("l").alias("side"), F.col("l").alias("p"), F.lit(0.0).alias("pc")).limit(0), inst.limit(0)
    for k in range(rounds):
        joined = edges.join(inst, ["kind", "inst"], "left")
        trust = F.col("s") + (F.col("n") - F.col("s")) * F.when(open_kind, F.coalesce("ic", F.lit(0.0))).otherwise(0.0)
        per = joined.withColumn("t", trust).select("kind", "n", "t", sides).select("kind", "n", "t", "x.side", "x.p").where("p is not null")
        pats = per.groupBy("kind", "side", "p").agg(F.sum("n").alias("uses"), F.least(F.lit(1.0), F.sum("t") / (F.lit(ENOUGH) * (F.sum("n") + 1))).alias("pc"))
        pats = cuts.cut(pats.where(F.col("uses") >= LEAST_USES), f"patterns{k}")
        left, right = (pats.where(F.col("side") == x).select("kind", F.col("p").alias(x), F.col("pc").alias(f"c{x}")) for x in "lr")
        seen = edges.join(left, ["kind", "l"], "left").join(right, ["kind", "r"], "left")
        best = F.greatest(F.coalesce("cl", F.lit(0.0)), F.when(F.col("kind") != "name", F.coalesce("cr", F.lit(0.0))).otherwise(0.0))
        score = F.col("s") + (F.col("n") - F.col("s")) * F.when(best >= TRUSTED, best).otherwise(0.0)
        inst = cuts.cut(seen.withColumn("t", score).groupBy("kind", "inst").agg(F.least(F.lit(1.0), F.sum("t") / (F.lit(ENOUGH) * (F.sum("n") + 1))).alias("ic")), f"inst{k + 1}")
    return pats, inst


def find_personal(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(table_name, record_id, kind, mention_no, start, stop): the mentions in rows (table_name, record_id, text), each record once.

    Offsets refer to the normalised text. Mentions of a kind in a record are counted from 1 in order. Records delivered
    twice count once, null ids and null or empty texts have no mentions, an empty table gives no rows.
    """
    cuts = Cuts(rows.sparkSession, "personal")
    found = cuts.cut(candidates(rows).distinct(), "candidates")
    pats, inst = bootstrap(found, cuts, rounds)
    left = pats.where("side = 'l'").select("kind", F.col("p").alias("l"), F.col("pc").alias("cl"))
    right = pats.where("side = 'r'").select("kind", F.col("p").alias("r"), F.col("pc").alias("cr"))
    given = inst.select("kind", "inst", "ic")
    d = join_unique(join_unique(join_unique(found, left, ["kind", "l"]), right, ["kind", "r"]), given, ["kind", "inst"])
    cl, cr, ic = (F.coalesce(c, F.lit(0.0)) for c in ("cl", "cr", "ic"))
    known = F.col("cl").isNotNull()
    score = (
        F.when(F.col("seed"), 1.0)
        .when(F.col("kind") == "email", F.greatest(cl, cr, ic))
        .when(F.col("kind") == "phone", F.when(known, F.greatest(cl, F.when(cl > 0, cr).otherwise(0.0))).otherwise(F.greatest(cr, ic)))
        .when(F.col("kind") == "id_number", F.greatest(ic, cr))
        .when(F.col("kind") == "address", F.greatest(cl, ic))
        .when(F.col("l").startswith("~"), F.when((ic >= TRUSTED) & (cl >= TRUSTED), ic).otherwise(0.0))
        .otherwise(F.greatest(cl, ic))
    )
    least = F.when(F.col("kind") == "phone", 0.1).otherwise(TRUSTED)
    good = d.withColumn("score", score).where(F.col("score") >= least)
    # of overlapping candidates the better one counts; within a record only
    order = {k: i for i, k in enumerate(KINDS)}
    rank = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])[F.col("kind")]
    record = Window.partitionBy("table_name", "record_id").orderBy("start", "stop")
    for _ in range(2):
        before = F.lag(F.struct("stop", "score", "rank")).over(record)
        after = F.lead(F.struct("start", "score", "rank")).over(record)
        good = good.withColumn("rank", rank).withColumn("b", before).withColumn("a", after)
        loses = ((F.col("b.stop") > F.col("start")) & ((F.col("b.score") > F.col("score")) | ((F.col("b.score") == F.col("score")) & (F.col("b.rank") <= F.col("rank"))))) | (
            (F.col("a.start") < F.col("stop")) & ((F.col("a.score") > F.col("score")) | ((F.col("a.score") == F.col("score")) & (F.col("a.rank") < F.col("rank"))))
        )
        good = good.where(~F.coalesce(loses, F.lit(False)))
    number = F.row_number().over(Window.partitionBy("table_name", "record_id", "kind").orderBy("start"))
    return good.select("table_name", "record_id", "kind", number.alias("mention_no"), "start", "stop")


def redact(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(table_name, record_id, text): normalised texts with [EMAIL_1], [NAME_2] and so on in place of the mentions."""
    spans = found.groupBy("table_name", "record_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind", "mention_no"))).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, marks in zip(pdf["text"], pdf["spans"]):
                text, parts, at = normalise(text), [], 0
                for s in marks if marks is not None else ():
                    parts += [text[at : s["start"]], f"[{s['kind'].upper()}_{s['mention_no']}]"]
                    at = s["stop"]
                out.append("".join(parts) + text[at:])
            yield pd.DataFrame({"table_name": pdf["table_name"], "record_id": pdf["record_id"], "text": out})

    once = rows.where("record_id is not null and text is not null").dropDuplicates(["table_name", "record_id"])
    return once.join(spans, ["table_name", "record_id"], "left").select("table_name", "record_id", "text", "spans").mapInPandas(run, "table_name string, record_id long, text string")
