"""Texts cut off by field limits or in transfer.

``at_limits`` follows the histograms of lengths, in characters and in bytes, per source and column: a limit is a spike at
the maximum of its time, and a value at a limit that doesn't end whole is cut. ``broken_ends`` looks for cuts elsewhere,
which have no length in common: texts that end inside a code block, an inline code, a link or a comment, or with a word
that hardly ever ends a line or sentence in all the texts, or is only the beginning of such words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstead.operators.joins import hot_keys, join_unique
from loomstead.sources.shared import Cuts

#: A spike has at least so many different texts, and so many times the mean of the lengths within WINDOW around it.
LEAST_AT_SPIKE, SPIKE_RATIO, WINDOW = 8, 5.0, 20
#: At a maximum, so many times fewer texts of the same months are longer. A cut within a character leaves up to WIDE bytes less.
ABOVE, WIDE = 0.1, 3
#: A word that ends a line or sentence in less than this share of its uses (longer words that begin with it included) ends no text.
END_SHARE = 0.1
#: A last line with a dotted end is a phrase if this share of the different texts (LEAST_AT_SPIKE of them at least) ends with it.
PHRASE_SHARE = 3e-4

# fixed values: characters without which a text is seen as it ends
INVISIBLE = "\\s\\x{200b}-\\x{200f}\\x{2028}\\x{2029}\\x{2060}\\x{feff}"
PICTURES = "\\p{So}¯\\x{fe0f}\\x{20e3}\\x{200d}\\x{1f3fb}-\\x{1f3ff}"
TERMINAL = ".!?。！？｡"
#: Marks that a cut leaves, and an opened tag at the end.
MARKS = r"(?i)(?:\[(?:\.\.\.|…)\]|[\[(](?:message |text |content )?(?:clipped|truncated|trimmed|snipped|cut off)[\])]|<[a-z]{1,12}|\x{fffd})\z"
CJK = "\\x{3005}-\\x{3007}\\x{3040}-\\x{30ff}\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}"


def ending(text: Column) -> Column:
    """The text without blanks, invisible characters, pictures and a smiley at its end, which is looked at from behind."""
    kinds = f"[{INVISIBLE}{PICTURES}]"
    tail = F.regexp_extract(F.reverse(text), f"(?U)\\A{kinds}*(?:[)(DP]-?[:;](?=\\s){kinds}+)?", 0)
    return F.left(text, F.length(text) - F.length(tail))


def _bytes(text: Column) -> Column:
    """Length in bytes without replacement characters at the end, which stand for the rest of a character cut within."""
    return F.octet_length(F.rtrim(text, F.lit("\ufffd")))


def length_spikes(values: DataFrame) -> DataFrame:
    """(source, unit, length, n, mean) of the limits among values (source, text, and created_at if there is one).

    unit is chars or bytes. A limit is a spike of the histogram at the maximum: in the months of the texts at that length
    hardly any text is longer. Months matter because a limit may be changed; without created_at there is one month.
    Repeated texts count once, so that a phrase many records share is no spike.
    """
    month = F.date_trunc("month", F.min("created_at")) if "created_at" in values.columns else F.lit(None).cast("timestamp")
    cut_char = F.col("text").endswith("\ufffd")
    texts = values.where("text is not null").withColumns({"h": F.xxhash64("text"), "chars": F.length("text"), "bytes": _bytes(F.col("text")), "cut_char": cut_char})
    texts = texts.groupBy("source", "h", "chars", "bytes", "cut_char").agg(month.alias("month"))
    sizes = F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))
    rows = texts.select("source", "month", F.explode(sizes).alias("s"), "cut_char").where((F.col("s.unit") == "bytes") | ~F.col("cut_char"))
    monthly = rows.groupBy("source", "s.unit", "month", "s.length").agg(F.count(F.lit(1)).alias("n"))
    of_month = Window.partitionBy("source", "unit", "month")
    longer = lambda by: F.coalesce(F.sum("n").over(of_month.orderBy("length").rangeBetween(by + 1, Window.unboundedFollowing)), F.lit(0))
    monthly = monthly.withColumns({"all": F.sum("n").over(of_month), "above": F.when(F.col("unit") == "bytes", longer(WIDE)).otherwise(longer(0))})
    # the shares of texts of this length, and of longer ones, in the months of the texts of this length
    share = lambda c: F.sum(F.col("n") * F.col(c) / F.col("all")).alias(c)
    counts = monthly.groupBy("source", "unit", "length").agg(F.sum("n").alias("n"), share("above"), F.sum(F.col("n") * F.col("n") / F.col("all")).alias("here"))
    near = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-WINDOW, WINDOW)
    last = F.max("length").over(Window.partitionBy("source", "unit"))
    # lengths that no text has count as 0; above the longest text there are none to compare with
    width = F.least(F.lit(WINDOW), last - F.col("length")) + F.lit(WINDOW)
    counts = counts.withColumn("mean", (F.sum("n").over(near) - F.col("n")) / F.greatest(width, F.lit(1)))
    spike = (F.col("n") >= LEAST_AT_SPIKE) & (F.col("n") >= F.lit(SPIKE_RATIO) * F.col("mean") + 3 * F.sqrt("mean")) & (F.col("length") > WINDOW)
    return counts.where(spike & (F.col("above") <= F.lit(ABOVE) * F.col("here"))).select("source", "unit", "length", "n", "mean")


def split_uses(text: Column) -> Column:
    """The words of a text in lower case; one that ends a line or sentence has a mark at its end."""
    lower = F.lower(F.concat(text, F.lit("\n")))
    end = f"(?:[{TERMINAL}…]+(?=\\s)|[ \\t]*[\\r\\n])?"
    every = lambda letters: F.regexp_extract_all(lower, F.lit(f"[{letters}]+{end}"), F.lit(0))
    return F.when(text.rlike(f"[{CJK}]"), every(f"\\p{{L}}\\p{{M}}\\p{{N}}_&&[^{CJK}]")).otherwise(every("\\p{L}\\p{M}\\p{N}_"))


def split_cjk(text: Column) -> Column:
    runs = F.regexp_extract_all(F.concat(text, F.lit("\n")), F.lit(f"[{CJK}]{{2,}}(?:[{TERMINAL}]|[ \\t]*[\\r\\n])?"), F.lit(0))
    parts = F.transform(runs, lambda r: F.struct(F.regexp_replace(r, f"[^{CJK}]+\\z", "").alias("c"), r.alias("r")))
    sized = F.transform(parts, lambda p: F.struct(p["c"].alias("c"), F.length(p["c"]).alias("n"), (p["r"] != p["c"]).alias("ended")))
    pairs = lambda p: F.transform(F.sequence(F.lit(1), p["n"] - 1), lambda i: F.concat(F.substr(p["c"], i, F.lit(2)), F.when((i == p["n"] - 1) & p["ended"], "\n").otherwise("")))
    return F.when(text.rlike(f"[{CJK}]{{2}}"), F.flatten(F.transform(sized, pairs))).otherwise(F.array().cast("array<string>"))


def word_uses(texts: DataFrame) -> DataFrame:
    """(word, n, n_end): uses of each word, and of those the ones that end a line or sentence."""
    used = texts.select(F.explode(F.concat(split_uses(F.col("text")), split_cjk(F.col("text")))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    word = F.regexp_replace("w", f"(?U)[\\s{TERMINAL}…]+\\z", "")
    return used.select(word.alias("word"), "n", F.when(F.col("w") != word, F.col("n")).otherwise(0).alias("e")).groupBy("word").agg(F.sum("n").alias("n"), F.sum("e").alias("n_end"))


def uses_beginning_with(uses: DataFrame, words: DataFrame, cuts: Cuts) -> DataFrame:
    """(word, n, n_word, n_end): the uses of each of ``words`` and of all longer words that begin with it, those of the word
    itself, and of the latter the ones that end something. A Chinese or Japanese word has no longer ones.

    Words that begin alike are neighbours in order, so sums up to two places tell their uses: all words and the wanted
    places are range-partitioned and sorted once, and summed up along the order; nothing grows with the length of words.
    """
    w = F.col("word")
    last = F.when(w.rlike(f"^[{CJK}]"), F.lit("\0")).otherwise(F.lit(chr(0x10FFFF)))
    places = words.select("word", F.explode(F.array(F.struct(F.lit(0).alias("place"), w.alias("k")), F.struct(F.lit(1).alias("place"), F.concat(w, F.lit("\0")).alias("k")), F.struct(F.lit(2).alias("place"), F.concat(w, last).alias("k")))).alias("x"))
    none = F.lit(0).cast("long")
    rows = places.select("x.k", "word", "x.place", none.alias("n"), none.alias("e")).unionByName(uses.select(w.alias("k"), F.lit(None).cast("string").alias("word"), F.lit(3).alias("place"), "n", F.col("n_end").alias("e")))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, e, part = 0, 0, None
        for pdf in batches:
            if len(pdf):
                up, ue = pdf["n"].cumsum() + n, pdf["e"].cumsum() + e
                n, e, part = int(up.iloc[-1]), int(ue.iloc[-1]), pdf["part"].iloc[0]
                at = pdf["place"] < 3
                yield pd.DataFrame({"part": pdf["part"][at], "word": pdf["word"][at], "place": pdf["place"][at], "n": up[at], "e": ue[at]})
        if part is not None:
            yield pd.DataFrame({"part": [part], "word": [None], "place": [3], "n": [n], "e": [e]})

    ordered = cuts.cut(rows, "places").repartitionByRange("k").sortWithinPartitions("k", "place")
    summed = cuts.cut(ordered.withColumn("part", F.spark_partition_id()).mapInPandas(sums, "part int, word string, place int, n long, e long"), "sums")
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = summed.where("place = 3").select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in "ne"])
    at = summed.where("place < 3").join(F.broadcast(offset), "part")
    up_to = lambda c, place: F.sum(F.when(F.col("place") == place, F.col(c) + F.col(f"{c}0")))
    return at.groupBy("word").agg((up_to("n", 2) - up_to("n", 0)).alias("n"), (up_to("n", 1) - up_to("n", 0)).alias("n_word"), (up_to("e", 1) - up_to("e", 0)).alias("n_end"))


def with_ends(docs: DataFrame) -> DataFrame:
    """Replace ``text`` by what its end shows; blank texts have no end and are left out."""
    d = docs.withColumn("core", ending(F.col("text"))).where("core <> ''")
    d = d.withColumn("lines", F.replace("core", F.lit("\r"), F.lit("\n")))
    d = d.withColumn("last", F.substring_index("lines", "\n", -1)).withColumn("line", F.trim("last"))
    rest = F.rtrim(F.left("lines", F.length("lines") - F.length("last")), F.lit(" \n\t"))
    d = d.withColumn("before", F.trim(F.substring_index(rest, "\n", -1)))
    fences = F.when(F.contains("lines", F.lit("```")), F.regexp_count("lines", F.lit("(?m)^[ \\t>\\x{200b}-\\x{200f}\\x{feff}]*```"))).otherwise(0)
    d = d.withColumn("fences", fences)
    line = F.col("line")
    listed = line.rlike("^(?:[-*+•]|\\d+[.)]) \\S") | line.rlike("^#{1,6} ")
    signed = F.col("before").rlike("(?i)^(?:--|[=_-]{3,}|(?:best |kind )?regards,?|best,?|cheers,?|thanks[\\w ]*,?|\\S+@\\S+|\\S+(?: \\S+){0,2},)\\z") & (F.size(F.split("line", " +")) <= 3)
    return d.select(
        *[c for c in d.columns if c not in ("text", "core", "lines", "last", "before", "fences")],
        (F.col("fences") % 2 == 1).alias("in_block"),
        ((F.col("fences") % 2 == 0) & ~line.rlike("^[ >]*```") & (F.regexp_count("line", F.lit("`")) % 2 == 1)).alias("in_code"),
        (F.contains("core", F.lit("<!--")) & (F.instr(F.substring_index("core", "<!--", -1), "-->") == 0) & (F.col("fences") % 2 == 0)).alias("in_comment"),
        line.rlike(MARKS).alias("mark"),
        line.rlike("(?:…|\\.\\.\\.)\\z").alias("dots"),
        (line.rlike(f"[{TERMINAL}][)\\]}}\"'’”»`*_]*\\z") & ~line.rlike("(?:…|\\.\\.\\.)\\z")).alias("terminal"),
        F.regexp_extract("line", "(https?://\\S*|www\\.\\S*)\\z", 1).alias("url"),
        (line.rlike("[,，、;；(（\\[{/\\\\=+&<|–-]\\z") & ~line.rlike("^([-=_*~#>])\\1*\\z")).alias("open_end"),
        F.lower(F.reverse(F.regexp_extract(F.reverse("line"), f"\\A[^\\p{{L}}\\p{{M}}\\p{{N}}_]*([{CJK}]{{1,2}}|[\\p{{L}}\\p{{M}}\\p{{N}}_&&[^{CJK}]]+)", 1))).alias("word"),
        listed.alias("listed"),
        signed.alias("signed"),
        (~F.contains("core", F.lit("\n")) & (F.length("core") <= 20) & (F.size(F.split("line", "\\s+")) <= 2) & ~line.rlike("[,，、;；]\\z")).alias("few"),
        F.xxhash64("line").alias("line_hash"),
        F.xxhash64("core").alias("core_hash"),
    )


def at_limits(sized: DataFrame, spikes: DataFrame) -> DataFrame:
    """Add ``at_spike`` to ``sized`` (source, chars, bytes, cut_char): whether a length is one of the limits of the source.

    A text that ends in a replacement character stands for one of up to WIDE bytes more.
    """
    of = spikes.groupBy(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("no_source")).agg(
        *[F.collect_set(F.when(F.col("unit") == u, F.col("length"))).alias(f"{u}_limits") for u in ("chars", "bytes")]
    )
    d = sized.withColumns({"s": F.coalesce("source", F.lit("")), "no_source": F.col("source").isNull()})
    d = join_unique(d, of, ["s", "no_source"], "left")
    reach = F.sequence("bytes", F.col("bytes") + F.when(F.col("cut_char"), WIDE).otherwise(0))
    hit = F.array_contains("chars_limits", F.col("chars")) | F.arrays_overlap("bytes_limits", reach)
    return d.withColumn("at_spike", F.coalesce(hit, F.lit(False))).drop("s", "no_source", "chars_limits", "bytes_limits")


def limit_cut() -> Column:
    """Whether a value at a limit doesn't end whole."""
    return F.col("at_spike") & ~F.col("terminal") & ~F.col("line").rlike("^[ >]*```")


def broken_ends(ends: DataFrame, texts: DataFrame, cuts: Cuts) -> DataFrame:
    """Add ``reason`` to ``ends``: what is broken off at the end of a text, judged by the uses of words in all ``texts``."""
    doubtful = ends.where(~F.col("terminal") & (F.col("word") != "")).select("word").distinct()
    # copies count once, so that the one use taken off below is all that a text's end adds
    uses = cuts.cut(word_uses(texts.select("text").distinct()), "uses")
    begins = cuts.cut(uses_beginning_with(uses, doubtful, cuts), "begins")
    # a line of several words and a dotted end that many different texts share is a phrase, not a cut
    lines = ends.where(F.col("dots") & (F.size(F.split("line", " +")) >= 3)).groupBy("line_hash").agg(F.count_distinct("core_hash").alias("same_line"), F.count(F.lit(1)).alias("rows"))
    least = ends.agg(F.greatest(F.lit(LEAST_AT_SPIKE), F.lit(PHRASE_SHARE) * F.count_distinct("core_hash")).alias("least"))
    phrases = cuts.cut(lines.crossJoin(F.broadcast(least)).where(F.col("same_line") >= F.col("least")).drop("least"), "phrases")
    d = join_unique(ends, begins, ["word"], "left")
    d = join_unique(d, phrases.drop("rows"), ["line_hash"], "left", hot_keys(phrases, ["line_hash"], "rows"))
    n, n_end, n_word = (F.coalesce(c, F.lit(0)) - 1 for c in ("n", "n_end", "n_word"))  # without this use
    rare = (n <= 0) | (n_end < F.lit(END_SHARE) * n)
    line = F.col("line")
    reason = (
        F.when(F.col("in_block"), "code block")
        .when(F.col("in_code"), "code")
        .when(F.col("in_comment") & ~F.col("terminal"), "comment")
        .when(F.col("mark"), "mark")
        .when(F.col("terminal") | F.col("few") | F.col("signed") | F.col("same_line").isNotNull(), None)
        .when(line.rlike("\\d{5} \\p{Lu}\\p{L}+\\z"), None)  # a postal address
        .when(line.rlike("<[^<>\\s]+[@:][^<>\\s]+>\\z"), None)
        .when(F.col("url") != "", F.when(~F.col("url").rlike("(?:/\\d+/?|/)\\z"), "link"))
        .when(line.rlike("^-->"), F.when(~line.rlike(":\\d+:\\d+\\z"), "link"))
        .when(F.col("open_end"), "sentence")
        .when(line.rlike("^[ >]*```") | line.endswith("-->"), None)
        .when(F.col("listed"), F.when((n > 0) & (n_word <= F.lit(0.01) * n), "sentence"))
        .when(line.endswith("}") | line.endswith('"'), None)
        .when((F.col("word") != "") & rare, "sentence")
    )
    return d.withColumn("reason", reason)


def find_cuts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, reason) of the cut texts among docs (doc_id, source, text, and created_at if there is one).

    The reason is ``limit`` for a text at a limit of its source that doesn't end whole, else what is broken off at its end.
    Null, empty and blank texts are no cases; a null source is a source of its own; repeated rows count once; an empty
    table gives no rows; extra columns are ignored. Counts cover all different texts.
    """
    cuts = Cuts(docs.sparkSession, "truncation")
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "source", "text", *[c for c in ("created_at",) if c in docs.columns])
    spikes = cuts.cut(length_spikes(docs), "spikes")
    sized = docs.drop("created_at").withColumns({"chars": F.length("text"), "bytes": _bytes(F.col("text")), "cut_char": F.col("text").endswith("\ufffd")})
    ends = cuts.cut(at_limits(with_ends(sized), spikes), "ends")
    found = broken_ends(ends, docs, cuts).withColumn("reason", F.when(limit_cut(), "limit").otherwise(F.col("reason")))
    return found.where("reason is not null").select("doc_id", "source", "reason").dropDuplicates(["doc_id"])


def cut_report(docs: DataFrame, cut: DataFrame) -> DataFrame:
    """Texts and cut texts per source, and the share."""
    all_ = docs.where("text is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"))
    n = cut.groupBy(F.col("source").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("reason") == "limit").alias("l"))
    out = all_.join(n, F.col("source").eqNullSafe(F.col("s")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select("source", "n_texts", zero("n").alias("n_cut"), zero("l").alias("n_at_limit"), (zero("n") / F.col("n_texts")).alias("share_cut"))
