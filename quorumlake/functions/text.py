"""Text functions over columns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that carry no meaning for retrieval, and those the claim search leaves out.
STOP_WORDS = "a an the of to in on for and or but is are was were be been being at by with from this that these those it its as we you they he she i do does did has have had will would can could should what which who whom when where why how not no yes about into over under out up down off".split()
NOISE_WORDS = "city council councilmember meeting said says say the and that this with from they their there have has was were for our you your what who how why are not but all its it a an of to in on is be by at".split()


def clean(x: Column) -> Column:
    """White space collapsed to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def norm_name(x: Column) -> Column:
    """Lower case; trimmed, then only letters, blanks, hyphens and apostrophes; blanks collapsed."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.lower(x)), r"[^a-z\s'-]", ""), r"\s+", " ")


def norm_word(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[^a-z0-9']", "")


def title_case(x: Column) -> Column:
    """Every run of letters with a capital first, wherever it begins; the rest small."""
    runs = F.regexp_extract_all(x, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2))))), "")


def slug(x: Column) -> Column:
    """Runs of other characters than letters and digits become one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def stem(w: Column) -> Column:
    """Light suffix stripping: plurals, then -ing or -ed, then a last e; words of three letters stay.

    A chain of replacements, so that the expression does not grow with each step.
    """
    plain = F.regexp_replace(w, "^(.{2,})ies$", "$1y")
    plain = F.regexp_replace(plain, "(ch|sh|ss|x|z)es$", "$1")
    plain = F.regexp_replace(plain, "(?<![su])s$", "")
    plain = F.regexp_replace(plain, "^(.{3,}?)(?:ing|ed)$", "$1")
    plain = F.regexp_replace(plain, "^(.{3,})e$", "$1")
    return F.when(F.length(w) <= 3, w).otherwise(plain)


def index_words(x: Column, places: tuple[str, ...] = ()) -> Column:
    """Letters and digits of two characters or more, lower case, without stop words and names of places.

    One pattern that passes over the words left out, as a filter over the array would test each word against each of them.
    """
    left_out = "|".join([*STOP_WORDS, *map(re.escape, places)])
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(f"(?<![a-z0-9])(?!(?:{left_out})(?![a-z0-9]))[a-z0-9]{{2,}}"), F.lit(0))


def tokens(x: Column, places: tuple[str, ...] = ()) -> Column:
    """Index tokens: the index words, stemmed."""
    return F.transform(index_words(x, places), stem)


def claim_tokens(x: Column) -> Column:
    """Tokens of the claim search, which keep percent signs, dots, dollars and hyphens within a word."""
    noise = F.array(*map(F.lit, NOISE_WORDS))
    words = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9][a-z0-9'%.$-]*"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~F.array_contains(noise, w))


def claim_word_set(x: Column) -> Column:
    """The different tokens of the claim search."""
    words = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9][a-z0-9'%.$-]+"), F.lit(0))
    return F.array_except(words, F.array(*map(F.lit, NOISE_WORDS)))


def long_word_set(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit("[a-z]{4,}"), F.lit(0)))


def sentences(x: Column) -> Column:
    """Sentences of a text: cut after an end mark followed by white space, empty ones left out."""
    marked = F.regexp_replace(clean(x), r"([.!?])\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: s != "")


def clip(x: Column, most: int) -> Column:
    """At most ``most`` characters, cut at the last blank beyond 60 percent of them, with an ellipsis."""
    head = F.left(x, F.lit(most))
    at = F.lit(most) - F.instr(F.reverse(head), " ")
    cut = F.when((F.instr(head, " ") > 0) & (at > 0.6 * most), F.left(head, at)).otherwise(head)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(cut), F.lit(" …")))


def excerpt(x: Column, most: int = 500) -> Column:
    return F.when(F.length(x) > most, F.concat(F.left(x, F.lit(most)), F.lit("…"))).otherwise(x)


def outcome_class(x: Column) -> Column:
    """passed, failed or other; what tells of passing is looked for first, so "not passed" counts as passed."""
    t = F.lower(F.coalesce(x, F.lit("")))
    has = lambda *words: reduce(lambda a, b: a | b, (t.contains(w) for w in words))
    return F.when(has("passed", "approved", "carried"), "passed").when(has("fail", "denied", "not pass"), "failed").otherwise("other")


def numeric(x: Column) -> Column:
    """A printed figure: a dash is 0, commas, dollars and percent signs are dropped, brackets mean minus."""
    t = F.trim(x)
    body = F.regexp_replace(t, r"[,$%()\s]", "")
    value = body.try_cast("double")
    return F.when(t.rlike("^[-–—]$"), F.lit(0.0)).when(t.rlike(r"^\(.*\)$"), -value).otherwise(value)


def initials(name: Column) -> Column:
    """First letters of the first and last word, upper case; of a single word its first twice, of none a question mark."""
    words = F.split(clean(F.coalesce(name, F.lit(""))), " ")
    both = F.concat(F.left(F.element_at(words, 1), F.lit(1)), F.left(F.element_at(words, -1), F.lit(1)))
    return F.upper(F.when(both == "", "?").otherwise(both))


def ordinal(n: Column) -> Column:
    two = F.pmod(n, F.lit(100))
    end = F.when(two.between(11, 13), "th").when(F.pmod(n, F.lit(10)) == 1, "st").when(F.pmod(n, F.lit(10)) == 2, "nd").when(F.pmod(n, F.lit(10)) == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)


def plural(n: Column, word: str) -> Column:
    return F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n == 1, "").otherwise("s"))


def escape_html(x: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(mark), F.lit(name))
    return x


def strip_tags(x: Column) -> Column:
    """The visible text of HTML, with the common entities resolved."""
    x = F.regexp_replace(x, "(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    for name, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(mark))
    return clean(x)


def wrap_join(left: Column, right: Column) -> Column:
    """Two lines as one: without a blank after a hyphen, else with one."""
    return F.when(left.endswith("-"), F.concat(left, right)).otherwise(F.concat_ws(" ", F.nullif(left, F.lit("")), F.nullif(right, F.lit(""))))


# Words that stay small in a title, and short forms that stay in capitals.
SMALL_WORDS = "a an and as at but by for from in into of on or the to with vs via".split()
CAPITALS = "rda cda cup hoa llc fy ii iii iv usa ada ems pd pud sid cip gis hr rfp rfq mda ldc".split()


def calm_caps(x: Column, share: float = 0.85) -> Column:
    """Title case for a text of which at least ``share`` of four letters or more are capitals; words with digits and short
    forms keep theirs, small words stay small unless they come first, the parts of a hyphenated word count as words."""
    letters, capitals = F.length(F.regexp_replace(x, "[^A-Za-z]", "")), F.length(F.regexp_replace(x, "[^A-Z]", ""))
    kept, small = F.array(*map(F.lit, CAPITALS)), F.array(*map(F.lit, SMALL_WORDS))

    def part(w: Column) -> Column:
        return F.concat(F.regexp_extract(w, "^[(\"']*", 0), F.initcap(F.lower(F.regexp_replace(w, "^[(\"']*", ""))))

    def word(w: Column, i: Column) -> Column:
        core = F.lower(F.regexp_replace(w, r"[()\[\]\"'.,:;]", ""))
        pieces = F.transform(F.split(w, "-"), lambda p: F.array_join(F.transform(F.split(p, "/"), lambda q: part(q)), "/"))
        return F.when(w.rlike("[0-9]") | F.array_contains(kept, core), w).when((i > 0) & F.array_contains(small, core), F.lower(w)).otherwise(F.array_join(pieces, "-"))

    return F.when((letters >= 4) & (capitals >= share * letters), F.array_join(F.transform(F.split(x, " "), word), " ")).otherwise(x)


def content_key(*parts: Column) -> Column:
    """Sixteen hexadecimal digits of the SHA-1 of the parts, nulls taken as empty."""
    return F.left(F.sha1(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts))), F.lit(16))


def whole_word(word: str) -> str:
    """A pattern for a word between characters that are no letters, the same in Java and RE2."""
    return f"(^|[^a-zà-ÿ]){word}([^a-zà-ÿ]|$)"


# Markers of claims going around and signs of something that can be checked, with their weights.
STRONG_MARKS = r"(i('ve| have)? (heard|been told)|i was told|people are saying|they('re| are) saying|everyone('s| is) saying|word (on the street|is)|(there('s| is) a |the )rumou?rs?|rumou?rs? (i|that|are|have)|someone (posted|said|told)|somebody (posted|said|told)|the (claim|story) (going around|is that))"
WEAK_MARKS = r"(i read (on|in|that)|(saw|read) (it )?on (facebook|social media|nextdoor|the internet)|(on|from) (facebook|social media|nextdoor)|going around|the word (out there|around))"
NO_CLAIM = r"(i('ve| have)? heard (you|him|her|them|from|a lot|that concern)|heard [a-z]+ say|(love|like|want|glad) to hear|hear from (you|the public|residents|citizens)|public hearing|hearing is (now )?(open|closed)|haven'?t heard|didn'?t hear|can you hear)"
CHECKABLE = [
    (r"[0-9]{1,3}(,[0-9]{3})+|[$] ?[0-9]|[0-9]+ ?(%|percent|million|acres|lanes|deputies|homes|units)", 2.4),
    (r"(the city|the council|the mayor|city hall|they) (is|are|was|were|has|have|had|will|would|voted|approved|sold|bought|paid|spent|plans?|allowing)", 2.0),
    (r"(^|[^a-z])(every|all|none|nobody|no one|always|never|only)([^a-z]|$)", 0.9),
    (r"(^|[^a-z])(approved|denied|sold|bought|rezoned|annexed|contract|lawsuit|secret|hidden|behind closed doors)([^a-z]|$)", 1.2),
    (r"(^|[^a-z])(data ?cent(er|re)|tax|sheriff|police|fire|water|road|highway|park|library|budget|developer)([^a-z]|$)", 0.8),
]


def claim_score(passage: Column, near: Column, strong_marks: str = STRONG_MARKS, weak_marks: str = WEAK_MARKS) -> Column:
    """How likely a passage carries a claim going around: a strong marker counts with all that can be checked in
    the passage, a weak one only with what stands in ``near``, the sentences at the marker."""
    low, close = F.lower(passage), F.lower(near)
    strong, weak = low.rlike(strong_marks), low.rlike(weak_marks)
    scope = F.when(strong, low).otherwise(close)
    total = F.when(strong, 3.0).otherwise(1.6)
    for pattern, weight in CHECKABLE:
        total = total + F.when(scope.rlike(pattern), weight).otherwise(0.0)
    marks = f"{strong_marks}|{weak_marks}"
    end, start = F.right(low, F.lit(60)), F.left(low, F.greatest(F.length(low) - 60, F.lit(0)))
    total = total - F.when(end.rlike(marks) & ~start.rlike(marks), 1.5).otherwise(0.0)
    total = total - F.when(F.size(F.split(clean(low), " ")) < 14, 1.2).otherwise(0.0)
    return F.when(low.rlike(NO_CLAIM) | ~(strong | weak), 0.0).otherwise(total)

# Titles that stand before a name.
NAME_TITLES = r"mayor pro tem|mayor|councilmember|council member|chief deputy|deputy|chief|mr\.|mrs\.|ms\.|dr\.|miss"


def bare_name(label: Column) -> Column:
    """The name without titles before it, a nickname in quotes and a role in brackets after it."""
    name = F.regexp_replace(F.trim(label), r"\s*\([^)]*\)\s*$", "")
    name = F.regexp_replace(name, rf"(?i)^(?:(?:{NAME_TITLES})\s+)+", "")
    return clean(F.regexp_replace(name, "\\s*[\"“”][^\"“”]*[\"“”]\\s*", " "))


def role_note(label: Column) -> Column:
    """What stands in brackets at the end of a label, else empty."""
    return F.trim(F.regexp_extract(F.trim(label), r"\(([^)]*)\)\s*$", 1))


def resolve_people(labels: DataFrame, column: str) -> DataFrame:
    """``labels`` with ``person``, ``role`` and ``candidates``: a lone first name is resolved only if just one full name begins with it."""
    named = labels.withColumns({"person": bare_name(F.col(column)), "role": role_note(F.col(column))})
    full = named.where(F.col("person").contains(" ")).select(F.col("person").alias("__p"), F.lower(F.element_at(F.split("person", " "), 1)).alias("__f")).distinct()
    first = full.groupBy("__f").agg(F.sort_array(F.collect_set("__p")).alias("candidates"))
    joined = named.withColumn("__f", F.when(~F.col("person").contains(" "), F.lower("person"))).join(first, "__f", "left").drop("__f")
    one = F.when(F.col("candidates").isNotNull() & (F.size("candidates") == 1), F.get("candidates", F.lit(0)))
    return joined.withColumn("person", F.when(F.col("person").contains(" "), F.col("person")).otherwise(one)).withColumn("candidates", F.coalesce("candidates", F.array().cast("array<string>")))


def reply_json(reply: Column) -> Column:
    """The JSON object in a model's reply, without a fence or words around it; null if there is none."""
    return F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit(""))


def canonical_url(url: Column, origin: str, default_body: str, keep: tuple[str, ...] = ("id", "body")) -> Column:
    """The address under one origin with only the parameters that choose content; the default body is left out."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), r"/index\.html$", "/")
    pairs = []
    for name in keep:
        value = F.nullif(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)), F.lit(""))
        value = F.when(value != default_body, value) if name == "body" else value
        pairs.append(F.when(value.isNotNull(), F.concat(F.lit(f"{name}="), value)))
    query = F.array_join(F.filter(F.array(*pairs), lambda p: p.isNotNull()), "&")
    return F.when(url.isNotNull(), F.concat(F.lit(origin), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def used_sources(sources: Column, answer: Column) -> Column:
    """The sources whose address the answer cites, else the first three; four at most."""
    cited = F.filter(sources, lambda s: (s["url"] != "") & F.contains(answer, s["url"]))
    return F.slice(F.when(F.size(cited) > 0, cited).otherwise(F.slice(sources, 1, 3)), 1, 4)


def split_kind(title: Column) -> tuple[Column, Column]:
    """("RESOLUTION", rest) of "RESOLUTION - rest"; else empty and the title."""
    pattern = r"^([A-Z][A-Z/ ]{2,40}?)\s*[-–]\s*(.*)$"
    kind = F.trim(F.regexp_extract(title, pattern, 1))
    return kind, F.when(kind != "", F.trim(F.regexp_extract(title, pattern, 2))).otherwise(title)


# ---- what is printed of a motion ----------------------------------------------------------------------------

def clean_title(x: Column, place: str) -> Column:
    """A title without the name of the place before what it does; ``place`` is a pattern, as "Fennby(?: City)?,? *Utah"."""
    head = rf"(?i)^((?:A\s+)?Resolution|(?:An\s+)?Ordinance)\s+of(?:\s+the\s+City\s+of)?\s+{place},?\s*"
    return clean(F.regexp_replace(x, head, "$1 "))


def unknown_outcome(x: Column) -> Column:
    return (F.trim(F.coalesce(x, F.lit(""))) == "") | F.lower(x).contains("not found")


def outcome_word(x: Column) -> Column:
    """Passed, Failed, else the outcome itself with a capital and without its full stop, Decided if there is none."""
    raw = F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), r"\.$", "")
    kind = outcome_class(x)
    return F.when(kind == "passed", "Passed").when(kind == "failed", "Failed").when(raw == "", "Decided").otherwise(F.concat(F.upper(F.left(raw, F.lit(1))), F.substr(raw, F.lit(2))))


def outcome_pill(x: Column) -> tuple[Column, Column]:
    """(class, label) of the mark beside a motion."""
    kind = F.when(unknown_outcome(x), "other").otherwise(outcome_class(x))
    return kind, F.when(unknown_outcome(x), "Not recorded").when(kind == "other", outcome_word(x)).otherwise(kind)


def outcome_sentence(x: Column, yes: Column, no: Column, other: Column) -> Column:
    """One line on the outcome and the roll call, which says so where the minutes are silent."""
    s = lambda c: c.cast("string")
    tally = F.concat(s(yes), F.lit("–"), s(no), F.when(other > 0, F.concat(F.lit("–"), s(other))).otherwise(""))
    none = yes + no + other == 0
    parts = F.concat(s(yes), F.lit(" yes, "), s(no), F.lit(" no"), F.when(other > 0, F.concat(F.lit(", "), s(other), F.lit(" other"))).otherwise(""))
    word = outcome_word(x)
    return (
        F.when(unknown_outcome(x) & none, "The minutes don’t record a result or a roll-call vote for this motion.")
        .when(unknown_outcome(x), F.concat(F.lit("The minutes don’t state the result. The roll call was "), tally, F.lit(".")))
        .when(none, F.concat(word, F.lit(". No roll-call vote was recorded.")))
        .when((outcome_class(x) == "passed") & (no == 0) & (other == 0), F.concat(F.lit("Passed unanimously, "), s(yes), F.lit("–0.")))
        .otherwise(F.concat(word, F.lit(" "), tally, F.lit(" ("), parts, F.lit(").")))
    )


def motion_title(headline: Column, title: Column, most: int = 140, least: int = 60) -> Column:
    """The headline, else the title, cut at the last blank beyond ``least`` where it is longer than ``most``."""
    head = F.left(title, F.lit(most))
    at = F.lit(most) - F.instr(F.reverse(head), " ")
    cut = F.regexp_replace(F.when((F.instr(head, " ") > 0) & (at > least), F.left(head, at)).otherwise(head), r"[,;:.\s]+$", "")
    shown = F.when(F.coalesce(title, F.lit("")) == "", "(no title)").when(F.length(title) <= most, title).otherwise(F.concat(cut, F.lit("…")))
    return F.coalesce(F.nullif(headline, F.lit("")), shown)


def without_speaker(x: Column) -> Column:
    """A sentence without the name and colon of who says it."""
    return F.trim(F.regexp_replace(x, r"^\s*(?:Speaker\s+[A-Z0-9]+|[A-Z][a-zA-Z.'-]+(?:\s+[A-Z][a-zA-Z.'-]+){0,3})\s*:\s*", ""))


# Wordings that tell what a question is after.
IDENTITY = r"(?i)^\s*who(?:'s|\s+(?:is|was|are|were))\b|\b(?:tell me|what do you know)\s+about\b"
TEMPORAL = r"(?i)\b(latest|recent|recently|current|currently|now|today|tonight|this (?:year|month|week)|upcoming|next|new|lately|so far|still|last (?:meeting|night|week|month|year))\b"
DISCUSSION = r"(?i)\b(said|say|says|saying|discuss|discussed|discussion|debate|debated|comment|comments|argue|argued|testimony|complain|concern|concerns|quote|explain|explained|reaction|resident|residents|speak|spoke|spoken|public comment|hearing)\b"


def question_cues(x: Column) -> dict[str, Column]:
    """identity, temporal and discussion: whether a question asks for them."""
    return {"identity": x.rlike(IDENTITY), "temporal": x.rlike(TEMPORAL), "discussion": x.rlike(DISCUSSION)}


def named_body(questions: DataFrame, question: str, bodies: DataFrame, fallback: str) -> DataFrame:
    """``questions`` with ``body``: the first body, by id, whose label stands in the question, else ``fallback``.

    Bodies (id, label) are a small dimension; Spark broadcasts them below its threshold.
    """
    labels = bodies.where("label <> ''").select(F.col("id").alias("__b"), F.lower("label").alias("__l"))
    low = questions.select(question).distinct().withColumn("__q", F.lower(question))
    hits = low.join(labels, F.contains("__q", F.col("__l"))).groupBy(question).agg(F.min("__b").alias("body"))
    return questions.join(hits, question, "left").withColumn("body", F.coalesce("body", F.lit(fallback)))


def cut_hard(x: Column, most: int) -> Column:
    """Collapsed white space, at most ``most`` characters."""
    return F.rtrim(F.left(clean(x), F.lit(most)))


def cut_at_sentence(x: Column, most: int) -> Column:
    """Collapsed white space, cut after the last whole sentence within ``most`` characters, else at them."""
    text = clean(x)
    head = F.left(text, F.lit(most))
    whole = F.regexp_extract(head, r"^(.*[.!?])(?:\s|$)", 1)
    return F.when(F.length(text) <= most, text).when(whole != "", whole).otherwise(F.rtrim(head))


def first_sentence(x: Column) -> Column:
    return F.coalesce(F.get(sentences(x), F.lit(0)), F.lit(""))


def stable_number(x: Column) -> Column:
    """A number for a text: the first twelve hexadecimal digits of its SHA-1."""
    return F.conv(F.left(F.sha1(x), F.lit(12)), 16, 10).cast("bigint")


def version_mark(x: Column) -> Column:
    """Ten hexadecimal digits of the SHA-1 of a text, to tell its versions apart."""
    return F.left(F.sha1(x), F.lit(10))


def inline_markdown(x: Column) -> Column:
    """Code, bold, emphasis and links of one paragraph as HTML; all else escaped."""
    t = escape_html(x)
    for pattern, html in ((r"`([^`]+)`", "<code>$1</code>"), (r"\*\*([^*]+)\*\*", "<strong>$1</strong>"), (r"\*([^*\s][^*]*)\*", "<em>$1</em>"), (r"\[([^\]]+)\]\((https?://[^)\s]+)\)", '<a href="$2">$1</a>')):
        t = F.regexp_replace(t, pattern, html)
    return t


def markdown(x: Column) -> Column:
    """Headings, lists and paragraphs of a small Markdown text as HTML; blocks are divided by blank lines."""
    t = inline_markdown(F.regexp_replace(x, r"\r\n?", "\n"))
    t = F.regexp_replace(t, r"(?m)^#{1,6}[ \t]+(.*)$", "\n\n<h3>$1</h3>\n\n")
    t = F.regexp_replace(t, r"(?m)^[-•][ \t]+(.*)$", "<li>$1</li>")
    t = F.regexp_replace(t, r"((?:<li>.*</li>\n?)+)", "\n\n<ul>$1</ul>\n\n")
    t = F.regexp_replace(t, r"\n</ul>", "</ul>")
    blocks = F.filter(F.transform(F.split(t, r"\n[ \t]*\n\s*"), lambda b: F.regexp_replace(F.regexp_replace(b, r"^\s+|\s+$", ""), r"\s*\n\s*", " ")), lambda b: b != "")
    return F.array_join(F.transform(blocks, lambda b: F.when(b.rlike("^<(h3|ul)>"), b).otherwise(F.concat(F.lit("<p>"), b, F.lit("</p>")))), "")
