"""Content column functions: page text, its size, feed dates.

``html_text`` is our own definition (the collectors call an external cleaner
whose code is not available): drop script/style/head/noscript blocks and
comments, drop tags, decode a fixed set of entities, squeeze blanks. Each
step is a ``regexp_replace``, so the body never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsarc.functions.common import col_of, let

# Blocks removed with their content, entity table, blank class.
DROPPED_BLOCKS = ("script", "style", "head", "noscript")
ENTITIES = (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"),
    ("&ndash;", "–"), ("&hellip;", "…"), ("&amp;", "&"),
)
BLANKS = r"[ \t\n\r\f\x0B]+"

# RFC-822 zone names and their offsets (feed dates).
ZONE_OFFSETS = (
    ("UT", "+0000"), ("GMT", "+0000"), ("Z", "+0000"),
    ("EST", "-0500"), ("EDT", "-0400"), ("CST", "-0600"), ("CDT", "-0500"),
    ("MST", "-0700"), ("MDT", "-0600"), ("PST", "-0800"), ("PDT", "-0700"),
    ("AKST", "-0900"), ("AKDT", "-0800"), ("HST", "-1000"),
)
# Accepted date layouts, tried in order after the weekday is cut.
DATE_PATTERNS = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm Z",
    "d MMM yy HH:mm:ss Z",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)


# One pass removes comments, the dropped blocks with their content, and every
# other tag; alternation order makes a block win over its own opening tag.
MARKUP = "(?is)<!--.*?-->|" + "|".join(
    f"<{tag}\\b[^>]*>.*?</{tag}\\s*>" for tag in DROPPED_BLOCKS) + "|<[^>]*>"


def html_text(html) -> Column:
    """Markup -> plain text (see module doc)."""
    t = F.regexp_replace(col_of(html), MARKUP, " ")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, BLANKS, " "))


def word_count(text) -> Column:
    """Words of a blank-squeezed text (as ``html_text`` returns it); reads ``text`` once."""
    return F.size(F.array_remove(F.split(col_of(text), " "), "")).cast("int")


def content_size(text, unit: str = "words") -> Column:
    """Size of a page text in ``words`` (stated rule) or ``chars`` (code)."""
    if unit == "words":
        return word_count(text)
    if unit == "chars":
        return F.length(col_of(text)).cast("int")
    raise ValueError(f"unit must be 'words' or 'chars', not {unit!r}")


def publication_time(text, fallback) -> Column:
    """Feed date text -> UTC timestamp, else ``fallback`` (the time seen).

    The weekday is cut (Spark 4 cannot parse ``EEE``), zone names become
    offsets, then each layout of DATE_PATTERNS is tried.
    """
    stripped = F.regexp_replace(F.regexp_replace(F.trim(col_of(text)), r"^[A-Za-z]{3},?\s*", ""),
                                r"\s+", " ")
    offsets = F.create_map(*[x for name, off in ZONE_OFFSETS for x in (F.lit(name), F.lit(off))])

    def normalise(s):          # a trailing zone name becomes its offset
        zone = F.regexp_extract(s, r" ([A-Z]{1,4})$", 1)
        return let(F.try_element_at(offsets, zone), lambda off: F.when(
            off.isNotNull(), F.concat(F.regexp_replace(s, r" [A-Z]{1,4}$", ""), F.lit(" "), off)).otherwise(s))

    def parse(t):              # the layout family is picked by shape; each pattern sees t once
        rfc = [F.try_to_timestamp(t, F.lit(p)) for p in DATE_PATTERNS if not p.startswith("yyyy-")]
        iso = [F.try_to_timestamp(t, F.lit(p)) for p in DATE_PATTERNS if p.startswith("yyyy-")]
        return (F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.coalesce(*iso))
                .when(t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{2}"), F.coalesce(*rfc)))

    parsed = let(let(stripped, normalise), parse)
    return F.coalesce(parsed, col_of(fallback))
