"""Column functions on review text. All stay in the JVM."""

from pyspark.sql import Column, functions as F

from reviewsent.schema import NEGATIVE, POSITIVE

_KEPT = {"ascii": "a-z", "unicode": r"\p{L}"}


def strip_tags(text: Column) -> Column:
    """Replace everything between ``<`` and the next ``>`` by a space.

    Texts without ``<`` are not given to the regular expression, and of the others only the
    part up to the last ``>``: there every ``<`` finds its end, so a text is read once
    however many ``<`` it has.
    """
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.when(F.contains(text, F.lit("<")), F.concat(F.regexp_replace(head, "<[^>]*>", " "), tail)).otherwise(text)


def letters_only(text: Column, letters: str = "ascii") -> Column:
    """Replace each character that is neither a kept letter nor whitespace by a space."""
    return F.regexp_replace(text, rf"[^{_KEPT[letters]}\s]", " ")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def normalise(text: Column, letters: str = "ascii") -> Column:
    """lower -> strip tags -> letters only -> collapse whitespace -> trim.

    A run of non-letters is whitespace after the letters step and one space after
    the collapse step, so both are one replacement of ``[^letters]+``: one regex
    pass over the text less, same result.
    """
    return normalise_lower(F.lower(text), letters)


def normalise_lower(text: Column, letters: str = "ascii") -> Column:
    """:func:`normalise` of text that is in lower case already."""
    return F.trim(F.regexp_replace(strip_tags(text), f"[^{_KEPT[letters]}]+", " "))


def tokens(text: Column) -> Column:
    """Tokens of normalised text (single spaces only)."""
    return F.split(text, " ")


def tokens_raw(text: Column) -> Column:
    """Tokens of any text: lower, split on each whitespace character, drop trailing empties.

    The same arrays as MLlib's ``Tokenizer``, but null for null text.
    """
    low = F.lower(text)
    cut = F.split(F.regexp_replace(low, r"\s+$", ""), r"\s")
    only_space = (F.length(low) > 0) & ~low.rlike(r"\S")
    return F.when(only_space, F.array().cast("array<string>")).otherwise(cut)


def split_words(text: Column) -> Column:
    """Whitespace split without empty words."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def in_list(word: str, listed: tuple[str, ...] | list[str]) -> str:
    """SQL condition ``word IN (...)``: one hash lookup, however long the list.

    Word lists go into the plan as SQL text, because ``Column.isin`` makes a round trip
    to the JVM for every single word.
    """
    if not listed:
        return "false"
    return f"{word} IN (" + ", ".join("'" + w.replace("'", "''") + "'" for w in listed) + ")"


def without_words(words: str, stop: tuple[str, ...], min_length: int = 0) -> Column:
    """Array ``words`` (a SQL expression) without stop words and short words; repeats are kept."""
    long_enough = f" AND length(w) >= {min_length}" if min_length > 0 else ""
    return F.expr(f"filter({words}, w -> NOT {in_list('w', stop)}{long_enough})")


def shorten(text: Column, n: int, ellipsis: str = "...") -> Column:
    """First ``n`` characters, with an ellipsis only where something was cut."""
    cut = F.substring(text, 1, n)
    return F.when(F.length(text) > n, F.concat(cut, F.lit(ellipsis)) if ellipsis else cut).otherwise(text)


def label_name(label: Column) -> Column:
    return F.when(label == 1, POSITIVE).when(label == 0, NEGATIVE)


def sentiment_label(score: Column) -> Column:
    """Score 1 -> 0, 2 -> 1, anything else -> null."""
    return F.when(score == 1, 0).when(score == 2, 1).cast("int")


def confidence(prediction: Column, prob_positive: Column) -> Column:
    """Probability of the predicted class."""
    return F.when(prediction == 1, prob_positive).otherwise(1 - prob_positive)
