"""Text expressions. All stay in the JVM and need no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and word characters, spelled out because Java's \s and \w
# are ASCII-only by default.
SPACE_CHARS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_CHARS}]+"
WORD_CHAR = r"[\p{L}\p{N}_]"

# The 32 ASCII punctuation marks.
PUNCTUATION = r"[!-/:-@\[-`{-~]"

# Contraction patterns and their replacements, applied in this
# order and without word boundaries.
CONTRACTIONS = (
    ("don't|dont", "do not"),
    ("doesn't|doesnt", "does not"),
    ("didn't|didnt", "did not"),
    ("isn't|isnt", "is not"),
    ("aren't|arent", "are not"),
    ("wasn't|wasnt", "was not"),
    ("weren't|werent", "were not"),
    ("can't|cant", "can not"),
    ("won't|wont", "will not"),
    ("wouldn't", "would not"),
    ("shouldn't", "should not"),
    ("couldn't", "could not"),
    ("haven't", "have not"),
    ("hasn't", "has not"),
    ("hadn't", "had not"),
    (rf"it's|its(?=[{SPACE_CHARS}])", "it is"),
    ("i'm", "i am"),
    ("i've", "i have"),
    ("i'll", "i will"),
    ("i'd", "i would"),
    ("you're", "you are"),
    ("they're", "they are"),
    ("we're", "we are"),
)

# Words added to the English stop list before topic modelling.
CUSTOM_STOP_WORDS = (
    "app", "boo", "hinge", "tinder", "bumble", "dating", "use", "like",
    "get", "also", "even", "make", "one", "would", "could", "really",
    "much", "well", "way", "thing", "go", "said", "say", "got", "lot",
    "let", "put", "see", "try", "good", "nice", "great", "love",
    "amazing", "bad", "worst", "horrible",
)

# Words left out of the word counts.
COUNT_STOP_WORDS = ("app", "people", "match", "dating", "hinge", "boo", "get", "like", "good", "bad")

# Opening words of a reply line that is not a review.
CHATTER = ("Here", "Sure", "I'll", "OK", "Certainly")


def squeeze(text: Column) -> Column:
    """Collapse white space to single blanks and strip the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def strip_space(text: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")


def clean_letters(text: Column) -> Column:
    """Lower case without ASCII punctuation and digits; null becomes 'nan'."""
    t = F.lower(F.coalesce(text, F.lit("nan")))
    # One class for whole runs; as alternatives, tried sign by sign, they take three times as long.
    return squeeze(F.regexp_replace(t, rf"{PUNCTUATION[:-1]}\p{{Nd}}]+", ""))


def clean_ascii(text: Column) -> Column:
    """Lower case with only a-z, 0-9 and white space; null becomes ''."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return strip_space(F.regexp_replace(t, f"[^a-z0-9{SPACE_CHARS}]", ""))


CLEANERS = {"letters": clean_letters, "ascii": clean_ascii}


def expand_contractions(text: Column) -> Column:
    return reduce(lambda t, rule: F.regexp_replace(t, rule[0], rule[1]), CONTRACTIONS, F.lower(text))


def emoji_to_words(text: Column, names: Mapping[str, str]) -> Column:
    """Replace each emoji of `names` by its name and tidy the text.

    `names` maps emoji (of one or more code points) to names such as
    'thumbs_up'; the longest match wins. The table is a fixed dictionary, so it
    travels as a literal and the text is rewritten in place: no join, no shuffle.
    """
    quoted = {e: "".join(rf"\x{{{ord(c):x}}}" for c in e) for e in sorted(names, key=lambda e: (-len(e), e))}
    first = "[" + "".join(sorted({rf"\x{{{ord(e[0]):x}}}" for e in names})) + "]"
    other = "[^" + first[1:]
    units = f"{other}+|(?={first})(?:{'|'.join(quoted.values())})|{first}"
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    pieces = F.transform(
        F.regexp_extract_all(text, F.lit(units), F.lit(0)),
        lambda u: F.when(
            u.rlike("^" + first), F.coalesce(F.concat(F.lit(" "), F.try_element_at(lookup, u), F.lit(" ")), u)
        ).otherwise(u),
    )
    named = F.when(text.rlike(first), F.array_join(pieces, "")).otherwise(text)
    return squeeze(F.translate(named, ":_", "  "))


def unfold(items: Column) -> Column:
    """explode() of a computed list column.

    Exploding the bare column makes Catalyst infer a size filter and push it,
    with a copy of the whole expression, below the projection that computes the
    list. The slice keeps the expression in one place.
    """
    return F.explode(F.slice(items, F.lit(1), F.size(items)))


def word_tokens(text: Column, stop_words: Sequence[str] = COUNT_STOP_WORDS, min_length: int = 3) -> Column:
    """Unicode words of the lower-cased text, without stop words and short words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "+"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(*stop_words))


def latin_tokens(text: Column, min_length: int = 3) -> Column:
    """Runs of a-z with at least min_length letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z]{%d,}" % min_length), F.lit(0))


def feature_tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Unicode words of two or more characters, lower-cased, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD_CHAR + "{2,}"), F.lit(0))
    return drop_stop_words(words, stop_words)


def split_words(text: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(squeeze(text), " "), lambda w: w != "")


def drop_stop_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(*stop_words)) if len(stop_words) else tokens


def first_k(text: Column, k: int = 8) -> Column:
    """The first k words joined by ', '."""
    return F.array_join(F.slice(split_words(text), 1, k), ", ")


def parse_replies(reply: Column, min_length: int = 6) -> Column:
    """Reviews of a reply: split on ##, stripped, longer than five characters."""
    parts = F.transform(F.split(reply, "##"), strip_space)
    return F.filter(parts, lambda p: F.length(p) >= min_length)


def parse_replies_strict(reply: Column, wanted: Column, min_length: int = 21) -> Column:
    """As parse_replies, without chatter lines and quotes, at most `wanted` of them."""
    lines = F.filter(
        F.split(reply, "\n"), lambda s: ~reduce(lambda a, b: a | b, [F.startswith(strip_space(s), F.lit(x)) for x in CHATTER])
    )
    kept = parse_replies(F.array_join(lines, "\n"), min_length)
    return F.slice(F.transform(kept, lambda p: F.replace(p, F.lit('"'), F.lit(""))), F.lit(1), wanted)


def parse_label(reply: Column, fallback: int = 1) -> Column:
    """'0', '1' or '2' after stripping; anything else, also null, is the fallback."""
    t = strip_space(reply)
    return F.when(t.isin("0", "1", "2"), F.substring(t, 1, 1).try_cast("int")).otherwise(fallback)


def file_prefix(name: Column) -> Column:
    """Lower-case part of a file name before the first underscore."""
    return F.lower(F.substring_index(name, "_", 1))
