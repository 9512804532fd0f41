"""Column expressions on text: normal forms, blanks, fillers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with marks and the letters they are folded to.
_MARKED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿčďěňřšťůžąćęłńśźżőű"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyycdenrstuzacelnszzou"

#: Invisible characters that carry no meaning inside words.
INVISIBLE = r"[\x{00AD}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{FEFF}\x{180E}]"
#: Characters taken as blank.
BLANKS = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

# What pages and exports write where a field is empty, in lower case.
FILLERS = [
    "n/a", "n.a.", "n.a", "na", "n. a.", "k. a.", "k.a.", "keine angabe", "none", "none given", "null", "nil", "nan", "undefined", "unknown",
    "not available", "not specified", "not given", "tbd", "tba", "tbc", "lorem", "lorem ipsum", "loading...", "loading…", "loading", "placeholder", "todo",
]


def fold(text: Column) -> Column:
    """Lower case without marks on letters and without invisible characters."""
    return F.translate(F.lower(F.regexp_replace(text, INVISIBLE, "")), _MARKED, _PLAIN)


def words(text: Column) -> Column:
    """Folded letters and digits, every run of anything else one space, none at the ends."""
    return F.trim(F.regexp_replace(fold(text), r"[^\p{L}\p{N}]+", " "))


def squeeze(text: Column) -> Column:
    """Runs of blanks as one space, none at the ends; '' becomes null."""
    t = F.trim(F.regexp_replace(text, f"{BLANKS}+", " "))
    return F.when(t != "", t)


def is_filled(text: Column) -> Column:
    """Whether a text holds a value: not null, blank, mere punctuation, a template placeholder or a filler word."""
    t = F.lower(F.trim(F.regexp_replace(text, f"{BLANKS}+", " ")))
    return F.coalesce(t.rlike(r"[\p{L}\p{N}]") & ~t.isin(FILLERS) & ~t.rlike(r"^(\{\{.*\}\}|\[object .*\]|<%.*%>|\$\{.*\}|%\w+%)$"), F.lit(False))
