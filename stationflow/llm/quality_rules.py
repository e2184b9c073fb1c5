"""Line-first quality rules: lines are judged and removed first, then documents that lost too much text are rejected.

All in column expressions; a row is judged by itself, so nothing is shuffled and no source or group can be hot.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"

# What lines of menus and of standing phrases look like, matched in lower case.
BOILERPLATE = ["cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "enable javascript", "subscribe to our",
               "sign up for", "click here", "skip to content", "share this", "follow us", "powered by", "lorem ipsum"]
NAVIGATION = ["home", "login", "log in", "sign in", "register", "search", "menu", "next", "previous", "contact", "about us", "sitemap", "back to top", "read more"]

HAS_WORD = r"[^\x20\x09-\x0D]"
#: A line ends a sentence, or a clause, with one of these, perhaps before closing marks.
ENDS = r"[.!?:;,…。！？]['\"”’»)\]]*[\x20\x09-\x0D]*$"
BOILERPLATE_LINE = "|".join(BOILERPLATE)
NAVIGATION_LINE = r"^[^a-z0-9]*(" + "|".join(NAVIGATION) + r")([^a-z0-9]+(" + "|".join(NAVIGATION) + r"))*[^a-z0-9]*$"
BARS = r"[|>»•·]"
#: Four parts between bars, arrows or bullets.
LINK_LIST = r"[|>»•·][^|>»•·]*[|>»•·][^|>»•·]*[|>»•·]"


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def size_without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def good_lines(lines: Column, text: Column, max_symbols: int = 30) -> Column:
    """The lines that pass the punctuation rule (a line ends as sentences do, with at most ``max_symbols`` percent symbols) and the
    navigation and boilerplate rules.

    The rules filter one after the other. A rule whose signs the whole text lacks cannot fail any of its lines and is skipped.
    """
    low = F.lower(text)
    phrase = reduce(or_, [F.contains(low, F.lit(p)) for p in BOILERPLATE + NAVIGATION])
    ended = F.filter(lines, lambda x: x.rlike(ENDS))
    worded = F.when(text.rlike(f"[{SYMBOLS}]"), F.filter(ended, lambda x: size_without(x, SYMBOLS) * 100 >= F.lit(100 - max_symbols) * F.char_length(x))).otherwise(ended)
    single = F.when(text.rlike(BARS), F.filter(worded, lambda x: ~x.rlike(LINK_LIST))).otherwise(worded)
    return F.when(phrase, F.filter(single, lambda x: ~F.lower(x).rlike(f"({NAVIGATION_LINE})|({BOILERPLATE_LINE})"))).otherwise(single)


def clean_lines(docs: DataFrame, text: str = "text", max_loss: float = 0.3) -> DataFrame:
    """``docs`` with ``clean_text`` (passing lines joined by line breaks), ``n_lines``, ``n_bad_lines`` (of those with a word),
    ``lost`` (share of the lines' characters removed) and ``line_verdict``: whether at most ``max_loss`` was lost and a line is left.

    Null, empty and wordless texts have no line, lose nothing and fail. Input columns of the added names are replaced.
    """
    lines = F.filter(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n"), lambda x: x.rlike(HAS_WORD))
    out = docs.withColumn("__lines", lines)
    out = out.withColumn("__good", good_lines(F.col("__lines"), F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    chars = [F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + F.char_length(x)) for c in ("__lines", "__good")]
    out = out.withColumns({"__all_chars": chars[0], "__good_chars": chars[1]})
    lost = F.when(F.col("__all_chars") > 0, 1 - F.col("__good_chars") / F.col("__all_chars")).otherwise(0.0)
    # compared as whole numbers, so that no rounding decides
    verdict = (F.size("__good") > 0) & ((F.col("__all_chars") - F.col("__good_chars")) * 100 <= F.lit(round(max_loss * 100)) * F.col("__all_chars"))
    return out.withColumns({
        "clean_text": F.array_join("__good", "\n"), "n_lines": F.size("__lines").cast("bigint"),
        "n_bad_lines": (F.size("__lines") - F.size("__good")).cast("bigint"), "lost": lost, "line_verdict": verdict,
    }).drop("__lines", "__good", "__all_chars", "__good_chars")


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``. A null text has no words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(HAS_WORD))
    out = docs.withColumns({"__words": words(whole), "__lines": lines})
    out = out.withColumns({"n_words": F.size("__words").cast("bigint"), "__n": F.size("__words") - 2})
    at = F.when(F.col("__n") > 0, F.sequence(F.lit(0), F.col("__n") - 1)).otherwise(F.array().cast("array<int>"))
    window = [lambda i, k=k: F.get("__words", i + k) for k in range(3)]
    out = out.withColumns({"__at": at, "__hashes": F.transform(at, lambda i: F.xxhash64(*[w(i) for w in window]))})
    # different hashes mean different windows; only texts with an equal pair of hashes go on to compare the windows themselves
    some = F.size(F.array_distinct("__hashes")) < F.col("__n")
    keyed = F.when(some, F.sort_array(F.transform("__at", lambda i: F.struct(F.concat_ws(" ", *[w(i) for w in window]).alias("w"), i.alias("i")))))
    out = out.withColumn("__sorted", keyed)

    def repeated(e, i):
        # get() gives null before the first and behind the last
        return F.coalesce(F.array_contains(F.array(F.get("__sorted", i - 1)["w"], F.get("__sorted", i + 1)["w"]), e["w"]), F.lit(False))

    found = F.filter("__sorted", repeated)
    covered = F.size(F.array_distinct(F.flatten(F.transform(found, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))
    out = out.withColumns({
        "word_chars": F.char_length(F.array_join("__words", "")).cast("bigint"), "n_symbols": F.char_length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")).cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "n_repeat_words": F.when(F.col("__sorted").isNull(), 0).otherwise(covered).cast("bigint"),
    })
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("__words", "__lines", "__n", "__at", "__hashes", "__sorted")


def judge(docs: DataFrame) -> DataFrame:
    """Statistics and verdict per row: a base failure rejects, otherwise the line rules decide."""
    out = base_statistics(clean_lines(docs.select("doc_id", "text")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & F.col("line_verdict")).alias("kept"), "n_lines", "n_bad_lines")
