"""Quality rules, line first (DataFrame functions only).

Every line of a text is judged by itself: a line that does not close with
sentence punctuation, that is full of symbols or shouting, that is a
navigation bar or that is boilerplate is removed. A boilerplate phrase counts
where it stands as words of its own, and fails a line that has at most
``SHORT_LINE`` words or that is half phrases. A document is rejected when the removed lines hold more than ``max_loss`` of its
characters, or when it fails one of the base rules (too few words, too much
of it inside repeated three-word windows).

Defined results: a null or empty text has no words and is rejected (fewer
than 50 words); lines without a word are neither judged nor counted; rows are
judged one by one, so repeated rows give repeated rows; extra columns are
ignored by ``quality_rules`` and kept by ``clean_documents``; an empty table
gives an empty result. Texts of any length are judged whole, in one row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import SPACE, fresh, let

# Limits of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS = 0.5
SHORT_LINE = 12

# Patterns of the line rules (the same in Java and RE2).
CLOSED = r"""[.!?:;,…]["')\]»”’]*[\x20\x09-\x0D]*$"""
SENTENCE_END = r"""[.!?…]["')\]»”’]*[\x20\x09]"""
SYMBOL = r"[#*$%&|<>{}~^=]"
SEPARATOR = r"(?:^|[\x20\x09])[|»›•·>](?:[\x20\x09]|$)"
SHOUT = r"!!"
ODD = r"[#*$%&|<>{}~^=»›•·]|!!"
BOILERPLATE = ["lorem ipsum", "all rights reserved", "cookie policy", "privacy policy",
               "terms of use", "terms of service", "enable javascript",
               "javascript is disabled", "click here", "read more", "sign up", "log in",
               "login", "subscribe to", "skip to content", "powered by", "share this",
               "back to top",
               # the same in German, French and Spanish
               "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen",
               "mehr lesen", "jetzt anmelden", "nach oben",
               "tous droits réservés", "politique de confidentialité", "lire la suite",
               "mentions légales", "se connecter", "haut de page",
               "todos los derechos reservados", "política de privacidad", "leer más",
               "términos de uso", "iniciar sesión", "volver arriba"]

PHRASE = r"(?iu)(?<![\p{L}\p{M}\p{N}_-])(?:" + "|".join(BOILERPLATE) + r")(?![\p{L}\p{M}\p{N}_-])"


def _line_fails(line: Column, odd: Column, phrases: Column) -> Column:
    """Whether a line goes. ``odd`` / ``phrases`` say whether the whole text
    holds any symbol or phrase that the dearer rules look for."""
    chars = F.length(line)
    words = F.size(F.filter(F.split(line, SPACE), lambda w: w != ""))
    phrase_chars = F.length(F.array_join(F.regexp_extract_all(line, F.lit(PHRASE), F.lit(0)), ""))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    return ((~line.rlike(CLOSED) & ~line.rlike(SENTENCE_END))
            | (odd & ((F.regexp_count(line, F.lit(SYMBOL)) * 10 > chars)
                      | (F.regexp_count(line, F.lit(SHOUT)) * 30 > chars)
                      | (line.rlike(SEPARATOR) & (separators >= 2) & (separators * 30 > chars))))
            | (phrases & line.rlike(PHRASE)
               & ((words <= SHORT_LINE) | (phrase_chars * 2 >= chars))))


def _repeat_words(words: Column) -> Column:
    """Words inside a three-word window that occurs twice or more.

    Only where some window hash repeats are the windows sorted by hash with
    their positions, so that equal windows are neighbours: n log n for a text
    of n words, without leaving the row.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1),
                                  F.get(words, i + 2))

    def covered(s: Column) -> Column:
        again = F.filter(s, lambda x, k: F.coalesce(x.h == F.get(s, k - 1).h, F.lit(False))
                         | F.coalesce(x.h == F.get(s, k + 1).h, F.lit(False)))
        spots = F.flatten(F.transform(again, lambda x: F.array(x.i, x.i + 1, x.i + 2)))
        return F.size(F.array_distinct(spots))

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0))
                .otherwise(let(F.sort_array(placed), covered)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(
        let(F.transform(starts, window), count))


def _verdict(text: Column, max_loss: float) -> Column:
    """All measures and the verdict of one text, as a struct."""
    body = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    flags = F.struct(
        body.rlike(ODD).alias("odd"),
        let(F.lower(body), lambda t: reduce(or_, [t.contains(p) for p in BOILERPLATE]))
        .alias("phrases"))
    judged = let(flags, lambda f: F.transform(
        F.filter(F.split(body, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]")),
        lambda l: F.struct(l.alias("line"),
                           _line_fails(l, f.odd, f.phrases).alias("fails"))))

    def measure(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"))

    def lines(j: Column) -> Column:
        text_lines = F.transform(j, lambda x: x.line)
        size = lambda xs: F.aggregate(xs, F.lit(0).cast("long"),
                                      lambda a, x: a + F.length(x.line))
        return F.struct(
            (F.size(j) - F.size(F.array_distinct(text_lines))).cast("long").alias("n_dup_lines"),
            size(j).alias("line_chars"),
            size(F.filter(j, lambda x: x.fails)).alias("lost_chars"),
            F.array_join(F.transform(F.filter(j, lambda x: ~x.fails), lambda x: x.line),
                         "\n").alias("cleaned"))

    symbols = F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long")

    def judge(m: Column) -> Column:
        base = ((m.w.n_words < MIN_WORDS)
                | (m.w.n_repeat_words * 100 > m.w.n_words * MAX_REPEAT_PERCENT))
        return F.struct(
            m.w.n_words.alias("n_words"), m.w.word_chars.alias("word_chars"),
            m.s.alias("n_symbols"), m.l.n_dup_lines.alias("n_dup_lines"),
            m.w.n_repeat_words.alias("n_repeat_words"), base.alias("base_failed"),
            (~base & (m.l.lost_chars <= m.l.line_chars * max_loss)).alias("kept"),
            m.l.line_chars.alias("line_chars"), m.l.lost_chars.alias("lost_chars"),
            m.l.cleaned.alias("cleaned"))

    return let(F.struct(let(words, measure).alias("w"), symbols.alias("s"),
                        let(judged, lines).alias("l")), judge)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per row of ``docs``: its id, the measures, ``base_failed``,
    ``kept``, and ``cleaned`` (the text without the removed lines)."""
    v = docs.select(F.col(f"`{id_col}`").alias(id_col),
                    _verdict(F.col(f"`{text_col}`"), max_loss).alias("v"))
    return v.select(id_col, "v.*")


def clean_documents(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars",
                    max_loss: float = MAX_LOSS) -> DataFrame:
    """The kept rows of ``docs`` with their cleaned text; other columns as
    they are, ``size_col`` (if there is one) set to the new length."""
    v = fresh(docs, "verdict")
    # A generator, so that the verdict is computed once and not once for every
    # column and filter that reads it.
    judged = docs.select("*", F.explode(F.array(_verdict(F.col(f"`{text_col}`"), max_loss)))
                         .alias(v))
    new = {text_col: F.col(f"{v}.cleaned")}
    if size_col in docs.columns:
        new[size_col] = F.length(F.col(f"{v}.cleaned")).cast(docs.schema[size_col].dataType)
    return judged.filter(F.col(f"{v}.kept")).withColumns(new).select(
        *[F.col(f"`{c}`") for c in docs.columns])
