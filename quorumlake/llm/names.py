"""Linking the spellings of persons and organisations.

Method: merge and rematch.  Every distinct spelling becomes a profile (surnames, given names, initials, suffix;
or the core words, type words and acronym of an organisation).  Profiles that match are merged: the union of
their spellings and initials is a richer profile, which enters the comparison again, until nothing merges any
more.  Whole names are merged first, then names with an initial, then bare surnames, and these only if just one
merged profile can be meant.

Scale: spellings are made distinct before anything else, with partial aggregation, so hot terms and hot names
cost nothing more.  Spellings that share a key (the surname with one letter dropped, its shape, an acronym) are
joined into families by passing least labels along keys, distributed and checkpointed; a family holds the
distinct spellings of like surnames in one term, never a term's rows, and only such a family is resolved in one
task, by look-ups in its own blocks.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.io import cut, spread
from quorumlake.llm.canonical import weighted_distance
from quorumlake.llm.scans import shape

# Short forms of given names, each line the long form and what stands for it.
NICKNAMES = """
alexander: alex al sandy xander lex | andrew: andy drew | anthony: tony ant | benjamin: ben benny benji | catherine: cathy kate katie cat
charles: charlie chuck chas | christopher: chris kit topher | daniel: dan danny | david: dave davy | deborah: deb debbie debby
dorothy: dot dottie dolly dory | edward: ed eddie ted ned teddy | eleanor: ellie nell nora ella lenny | elizabeth: liz beth betty lizzie eliza betsy libby
frances: fran frankie fanny francie | gerald: gerry jerry | gregory: greg gregg | harold: hal harry | jacqueline: jackie jacqui | james: jim jimmy jamie
jennifer: jen jenny jenn | joseph: joe joey jos | katherine: kate kathy katie kat kathie kit kay | lawrence: larry laurie lars | margaret: maggie meg peggy marge margie greta madge
michael: mike mick mickey mikey | nicholas: nick nicky nico | pamela: pam pammy | patricia: pat patty trish tricia patti | rebecca: becky becca reba
richard: rick dick rich richie ricky | robert: bob rob bobby robbie bert | ronald: ron ronnie | samuel: sam sammy | stephen: steve stevie steph
susan: sue susie suzie suzy | theodore: ted theo teddy | thomas: tom tommy | timothy: tim timmy | victoria: vicky vicki tori vic vickie
william: bill will billy willie liam wm | zachary: zach zack zac | john: jack johnny jon | matthew: matt matty | barbara: barb babs barbie
kenneth: ken kenny | donald: don donny | raymond: ray | peter: pete | philip: phil | leonard: len lenny leo | judith: judy | cynthia: cindy
sandra: sandy | virginia: ginny | walter: walt wally | arthur: art artie | albert: al bert | alfred: al fred | frederick: fred freddy rick | henry: hank harry
jonathan: jon jonny | joshua: josh | nathan: nate | nathaniel: nate nat | vincent: vince vinnie | abigail: abby gail | amanda: mandy | christine: chris chrissy tina
ines: inez | ingrid: inga inge | tomas: tom tommy
"""
# Titles and roles, suffixes, and the type words of organisations with their short forms.
TITLES = set("mr ms mrs miss dr mayor councilmember councilman councilwoman councillor councilor council commissioner comm cm board member chair chairman chairwoman chairperson vice president director chief trustee judge hon honorable clerk pro tem acting deputy".split())
ROLES = TITLES | set("city town county fire police recorder attorney manager planner engineer superintendent finance library parks water treasurer applicant representative resident secretary administrator public works staff owner agent petitioner of the and & rep".split())
SUFFIXES = {"jr": "jr", "sr": "sr", "junior": "jr", "senior": "sr", "ii": "ii", "iii": "iii"}
NOBODY = set("illegible missing unknown vacant none clerk name unclear inaudible staff blank absent all unanimous nobody voter roll call quorum present n/a na tbd unreadable speaker public".split())
TYPES = {
    "incorporated": "inc incorp", "company": "co comp cmpy", "association": "assn assoc ass'n", "district": "dist distr", "partners": "ptrs prtnrs partner ptnrs",
    "group": "grp gp", "engineering": "engr eng engrg", "irrigation": "irrig irr", "neighborhood": "nbhd neighbourhood nhbd", "homes": "home hms", "land": "lnd", "water": "wtr", "llc": "l.l.c",
    "corporation": "corp", "limited": "ltd", "development": "dev", "services": "svcs", "committee": "cmte", "foundation": "fdn", "trust": "", "builders": "bldrs", "properties": "props", "authority": "auth", "council": "",
}
_TYPE_OF = {short: long_ for long_, shorts in TYPES.items() for short in [long_, *shorts.split()]}
_LEGAL = {"llc", "limited", "corporation"}
_ACRONYM = re.compile(r"[A-Z](?:[a&]?[A-Z]){1,6}")

_SHORT: dict[str, set[str]] = defaultdict(set)
for _line in re.split(r"[|\n]", NICKNAMES):
    if ":" in _line:
        _long, _forms = _line.split(":")
        for _form in [_long.strip(), *_forms.split()]:
            _SHORT[_form].add(_long.strip())


def flat(text: str) -> str:
    """Lower case without accents."""
    text = unicodedata.normalize("NFKD", text.lower().replace("ø", "o").replace("ł", "l").replace("ß", "ss").replace("æ", "ae"))
    return "".join(c for c in text if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def _near(a: str, b: str, limit: float) -> bool:
    return a == b or weighted_distance(a, b, limit) <= limit or weighted_distance(b, a, limit) <= limit


def like_surnames(a: str, b: str) -> bool:
    """Equal, or a typing or scanning error apart."""
    if a == b:
        return True
    if a[-1:].isdigit() != b[-1:].isdigit() and min(len(a), len(b)) < 4:
        return False
    n = min(len(a), len(b))
    if n >= 4 and (_near(a, b, 1.1 if n < 7 else 1.7) or n >= 6 and shape(a) == shape(b)):
        return True
    x, y = a.split("-"), b.split("-")
    return len(x) == len(y) > 1 and all(like_surnames(p, q) for p, q in zip(x, y))


def part_of_surname(a: str, b: str) -> bool:
    """Whether one is a part of the other, a double surname."""
    x, y = (a, b) if "-" in b else (b, a)
    return "-" in y and "-" not in x and any(like_surnames(x, part) for part in y.split("-") if len(part) > 3)


def like_given(a: str, b: str) -> bool:
    """Equal, a typing error apart, or one short for the other; an initial is like every name it begins."""
    if a == b:
        return True
    if len(a) == 1 or len(b) == 1:
        return a[0] == b[0] or any(x[0] == min(a, b, key=len) for x in _SHORT.get(max(a, b, key=len), ()))
    if _SHORT.get(a, set()) & _SHORT.get(b, set()):
        return True
    n = min(len(a), len(b))
    if a in _SHORT and b in _SHORT:
        return False
    return _near(a, b, 1.1) if n >= 4 else a[0] == b[0] and _near(a, b, 0.7 if n == 3 else 0.0)


class Profile:
    """What the merged spellings say together."""

    __slots__ = ("names", "weight", "kind", "surnames", "given", "middle", "suffix", "core", "types", "printed", "acronym")

    def __init__(self, kind: str):
        self.kind, self.names, self.weight = kind, [], 0
        self.surnames, self.given, self.middle, self.suffix = {}, set(), set(), set()
        self.core, self.types, self.printed, self.acronym = (), set(), (), None

    def absorb(self, other: Profile) -> None:
        self.names += other.names
        self.weight += other.weight
        for s, n in other.surnames.items():
            self.surnames[s] = self.surnames.get(s, 0) + n
        self.given |= other.given
        self.middle |= other.middle
        self.suffix |= other.suffix
        self.types |= other.types
        self.core = self.core or other.core
        self.printed = max(self.printed, other.printed, key=len)  # types in the order in which the fullest spelling has them
        self.acronym = self.acronym or other.acronym

    @property
    def full(self) -> set[str]:
        return {g for g in self.given if len(g) > 1}


def parse(name: str | None, count: int = 1) -> Profile | None:
    """The profile of one spelling; None if it names nobody."""
    if name is None:
        return None
    text = unicodedata.normalize("NFKC", name)
    text = re.sub(r"^[\s*\-–—•]+|[\s*†‡]+$", "", text)
    bare = re.sub(r"\([^)]*\)", " ", text)
    bare = re.sub(r"\s+", " ", bare).strip(" ,;")
    if _ACRONYM.fullmatch(bare) and 2 <= len(bare) <= 7 and not (bare[0] + bare[1:].lower()).lower() in TITLES:
        p = Profile("org")
        p.names, p.weight, p.acronym = [name], count, bare.replace("&", "a")
        return p
    parts = [x.strip() for x in bare.split(",") if x.strip()]
    if not parts:
        return None
    head, reversed_given, suffix = parts[0], None, None
    for part in parts[1:]:
        words = [w.strip(".") for w in flat(part).split()]
        if len(words) == 1 and words[0] in SUFFIXES:
            suffix = SUFFIXES[words[0]]
        elif all(w in _TYPE_OF for w in words):
            head = f"{head} {part}"
        elif all(w in ROLES for w in words):
            continue
        elif reversed_given is None:
            reversed_given = part
    words = head.split()
    low = [flat(w).strip(".,;:'\"") for w in words]
    org = _organisation(low)
    if org and reversed_given is None:
        p = Profile("org")
        p.names, p.weight, (p.core, types) = [name], count, org
        p.types, p.printed = set(types), tuple(types)
        return p if p.core else None
    while low and low[0] in TITLES:
        low.pop(0)
    while low and low[-1] in SUFFIXES and len(low) > 1:
        suffix = SUFFIXES[low.pop()]
    given = [flat(w).strip(".'\"") for w in (reversed_given or "").split()]
    given = [g for g in given if g]
    while given and given[-1] in SUFFIXES:
        suffix = SUFFIXES[given.pop()]
    while given and given[0] in TITLES:
        given.pop(0)
    low = [w for w in low if re.search(r"[a-z]", w)]
    if not low or all(w in NOBODY or w in ROLES for w in low):
        return None
    surname, before = low[-1], low[:-1]
    if len(before) > (0 if given else 1) and len(before[-1]) > 3 and before[-1].isalpha():
        surname = f"{before.pop()}-{surname}"  # a double surname typed without its hyphen
    given = given or before
    if len(surname) < 2:
        return None
    p = Profile("person")
    p.names, p.weight, p.surnames = [name], count, {surname: count}
    if given:
        p.given = {given[0]}
        p.middle = {g[0] for g in given[1:]}
    if suffix:
        p.suffix = {suffix}
    return p


def _organisation(low: list[str]) -> tuple[tuple[str, ...], list[str]] | None:
    """(core words, type words) of an organisation, else None."""
    words = [w for w in low if w not in ("the", "representative", "rep", "applicant", "and", "&", "")]
    kinds = [_TYPE_OF.get(w) or next((t for t in TYPES if len(w) >= 6 and w not in TITLES and _near(w, t, 1.1)), None) for w in words]
    if "of" in words and words.index("of") > 0 and all(kinds[: words.index("of")]):
        at = words.index("of")
        return tuple(words[at + 1 :]), [k for k in kinds[:at] if k]
    types = []
    while words and kinds[-1] and len(words) > 1:
        types.insert(0, kinds.pop())
        words.pop()
    return (tuple(words), types) if types else None


def initials(p: Profile, more: str = "") -> set[str]:
    """Acronyms that the words of an organisation make, with and without a letter for "and", and with a letter more."""
    letters = "".join(w[0] for w in p.core).upper()
    tail = "".join(t[0] for t in p.printed if t not in _LEGAL).upper() + more
    out = {letters + tail}
    if len(p.core) == 2:
        out.add(f"{letters[0]}a{letters[1]}{tail}")
    return out


def keys(p: Profile) -> list[str]:
    """Keys one of which any two spellings of one entity are apt to share."""
    out = set()
    if p.kind == "org":
        out.add(f"a:{p.acronym}") if p.acronym else out.update(f"a:{x}" for x in initials(p) | _full_acronyms(p))
        for w in p.core[:1]:
            out.update(f"o:{w[:k] + w[k + 1 :]}" for k in range(len(w)))
            out.update((f"o:{w}", f"p:{shape(w)}"))
        return sorted(out)
    for whole in p.surnames:
        for s in {whole, *(x for x in whole.split("-") if len(x) > 3)}:
            out.update(f"s:{s[:k] + s[k + 1 :]}" for k in range(len(s)))
            out.update((f"s:{s}", f"h:{shape(s)}"))
    return sorted(out)


def _full_acronyms(p: Profile) -> set[str]:
    """Acronyms with one letter more, that of a type word which a spelling with a single one may have left out."""
    if len(p.types - _LEGAL) != 1:
        return set()
    return {x for first in {t[0].upper() for t in TYPES if t not in p.types} for x in initials(p, first)}


# ---- deciding ------------------------------------------------------------------------------------------------


def same_org(a: Profile, b: Profile) -> bool:
    if a.acronym and not a.core or b.acronym and not b.core:
        x, y = (a, b) if a.acronym and not a.core else (b, a)
        return x.acronym == y.acronym or bool(y.core) and x.acronym in initials(y) | _full_acronyms(y)
    ta, tb = a.types - _LEGAL, b.types - _LEGAL
    return len(a.core) == len(b.core) and all(like_surnames(x, y) for x, y in zip(a.core, b.core)) and (ta <= tb or tb <= ta)


def _suffixes_agree(a: Profile, b: Profile) -> bool:
    return not a.suffix or not b.suffix or a.suffix == b.suffix


def same_whole(a: Profile, b: Profile) -> bool:
    """Two profiles with given names written out."""
    if not _suffixes_agree(a, b) or bool(a.suffix) != bool(b.suffix):
        return False
    if a.middle and b.middle and not a.middle & b.middle:
        return False
    if any(like_given(x, y) for x in a.full for y in b.full):
        return _surnames_like(a, b) or _surname_in_part(a, b)
    # a given name of three letters or so is all but lost with one error; the very surname must vouch for it
    short = any(x[0] == y[0] and min(len(x), len(y)) in (2, 3) and len(x) + len(y) < 8 and _near(x, y, 1.0) for x in a.full - _SHORT.keys() for y in b.full)
    return short and bool(a.surnames.keys() & b.surnames.keys())


def _surnames_like(a: Profile, b: Profile) -> bool:
    return bool(a.surnames.keys() & b.surnames.keys()) or any(like_surnames(x, y) for x in a.surnames for y in b.surnames)


def _surname_in_part(a: Profile, b: Profile) -> bool:
    return any(part_of_surname(x, y) for x in a.surnames for y in b.surnames)


def may_mean(part: Profile, whole: Profile) -> bool:
    """Whether a name with an initial, or a bare surname, can stand for the profile (surnames apart)."""
    if not _suffixes_agree(part, whole):
        return False
    return not part.given or not whole.given or any(like_given(x, y) for x in part.given for y in whole.given)


def resolve(spellings: list[tuple[str, int]]) -> dict[str, int]:
    """The number of its entity for each spelling that names somebody, by merging and matching again."""
    profiles = [p for p in (parse(n, c) for n, c in sorted(spellings, key=lambda x: (-x[1], x[0]))) if p]
    orgs, people = [p for p in profiles if p.kind == "org"], [p for p in profiles if p.kind == "person"]
    merged = _merge_orgs(orgs) + _merge_people(people)
    return {name: k for k, p in enumerate(merged) for name in p.names}


def _merge(profiles: list[Profile], same, block) -> list[Profile]:
    """Merges profiles until no further merge occurs; block gives the keys under which a profile is looked up."""
    queue, index, alive = deque(profiles), defaultdict(list), {}
    while queue:
        p = queue.popleft()
        found = next((q for k in sorted(block(p)) for q in index[k] if id(q) in alive and same(p, q)), None)
        if found is None:
            alive[id(p)] = p
            for k in block(p):
                index[k].append(p)
        else:
            del alive[id(found)]
            found.absorb(p)
            queue.appendleft(found)  # the richer profile is matched again
    return list(alive.values())


def _merge_orgs(orgs: list[Profile]) -> list[Profile]:
    """Whole names first; then acronyms, and names without their last type word, where just one can be meant."""
    named = _merge([p for p in orgs if p.core], lambda a, b: same_org(a, b) and (len(a.types - _LEGAL) == len(b.types - _LEGAL)), lambda p: {k for k in keys(p) if k[0] in "op"})
    named = _unique(named, lambda p: len(p.types - _LEGAL) < 2, same_org)
    short = _merge([p for p in orgs if not p.core], same_org, keys)
    return _unique(named + short, lambda p: not p.core, same_org)


def _blocked(profiles: list[Profile]) -> dict[str, list[Profile]]:
    index: dict[str, list[Profile]] = defaultdict(list)
    for q in profiles:
        for k in keys(q):
            index[k].append(q)
    return index


def _near_ones(p: Profile, index: dict[str, list[Profile]]) -> list[Profile]:
    """Profiles that share a key with this one, each once."""
    return list({id(q): q for k in keys(p) for q in index.get(k, ()) if q is not p}.values())


def _unique(profiles: list[Profile], partial, same) -> list[Profile]:
    """Merges each partial profile into the one other of its blocks that it can mean; where there are several, into none."""
    gone: set[int] = set()
    again = True
    while again:
        again = False
        index = _blocked([q for q in profiles if id(q) not in gone and not partial(q)])
        for p in profiles:
            if id(p) in gone or not partial(p):
                continue
            fits = [q for q in _near_ones(p, index) if same(p, q)]
            if len(fits) == 1:
                gone.add(id(p))
                fits[0].absorb(p)
                again = True
    return [q for q in profiles if id(q) not in gone]


def _person_block(p: Profile) -> set[str]:
    return set(keys(p))


def _merge_people(people: list[Profile]) -> list[Profile]:
    whole = _merge([p for p in people if p.full], same_whole, _person_block)
    whole = _bare_suffixes(whole)
    parts = [p for p in people if not p.full]
    again = True
    while again:  # the surnames and initials a profile has gained may decide for a part that could not be placed before
        again = False
        index: dict[str, list[Profile]] = defaultdict(list)
        for q in whole:
            for k in _person_block(q):
                index[k].append(q)
        for with_initial in (True, False):
            for p in [x for x in parts if bool(x.given) == with_initial]:
                near = {id(q): q for k in _person_block(p) for q in index[k]}
                fits = _fits(p, list(near.values()))
                if len(fits) == 1:
                    fits[0].absorb(p)
                    parts.remove(p)
                    again = True
                    for k in _person_block(p):
                        if fits[0] not in index[k]:
                            index[k].append(fits[0])
    # parts that no whole name explains: those with an initial among themselves, then bare surnames to them
    lone = _merge([p for p in parts if p.given], lambda a, b: may_mean(a, b) and _surnames_like(a, b) and _suffixes_agree(a, b), _person_block)
    rest = []
    for p in _merge([p for p in parts if not p.given], lambda a, b: _surnames_like(a, b) and a.suffix == b.suffix, _person_block):
        blocked = _fits(p, whole)
        fits = [q for q in lone if may_mean(p, q) and _surnames_like(p, q)]
        if len(fits) == 1 and not blocked:
            fits[0].absorb(p)
        else:
            rest.append(p)
    return whole + lone + rest


def _bare_suffixes(whole: list[Profile]) -> list[Profile]:
    """A whole name without suffix is the one bearer of that name with a suffix, if there is just one."""
    index, gone = _blocked([q for q in whole if q.suffix]), set()
    for p in whole:
        if p.suffix:
            continue
        fits = [q for q in _near_ones(p, index) if _surnames_like(p, q) and any(like_given(x, y) for x in p.full for y in q.full)]
        if len(fits) == 1 and (not p.middle or not fits[0].middle or p.middle & fits[0].middle):
            gone.add(id(p))
            fits[0].absorb(p)
    return [q for q in whole if id(q) not in gone]


def _fits(p: Profile, whole: list[Profile]) -> list[Profile]:
    """Whole profiles that a part may mean: those with its very surname, else those with a like one."""
    exact = [q for q in whole if p.surnames.keys() & q.surnames.keys() and may_mean(p, q)]
    if exact:
        # of several, those in which this is the usual surname, not an error of another
        usual = [q for q in exact if max(q.surnames, key=lambda s: (q.surnames[s], s)) in p.surnames]
        return usual or exact
    like = [q for q in whole if may_mean(p, q) and _surnames_like(p, q)]
    return like or [q for q in whole if may_mean(p, q) and _surname_in_part(p, q)]


# ---- over tables --------------------------------------------------------------------------------------------


def families(spellings: DataFrame, rounds: int = 50) -> DataFrame:
    """(term_id, name, n, family) for (term_id, name, n): spellings linked by shared keys have one family.

    Least labels are passed from spellings to keys and back until none changes; each round is checkpointed.
    """
    term = spellings.schema["term_id"].dataType.simpleString()

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(t, n, k) for t, n in zip(batch["term_id"], batch["name"]) if (p := parse(n)) for k in keys(p)]
            yield pd.DataFrame(rows, columns=["term_id", "name", "key"])

    links = cut(spread(spellings.select("term_id", "name"), "term_id", "name").mapInPandas(keyed, f"term_id {term}, name string, key string"))
    labels = cut(links.select("term_id", "name").distinct().withColumn("family", F.col("name")))
    for _ in range(rounds):
        least = links.join(labels, ["term_id", "name"]).groupBy("term_id", "key").agg(F.min("family").alias("family"))
        lower = links.join(least, ["term_id", "key"]).groupBy("term_id", "name").agg(F.min("family").alias("__new"))
        after = cut(labels.join(lower, ["term_id", "name"]).select("term_id", "name", F.least("family", "__new").alias("family"), (F.col("__new") < F.col("family")).alias("__moved")))
        labels = after.select("term_id", "name", "family")
        if after.where("__moved").isEmpty():
            break
    else:
        raise RuntimeError(f"the families did not settle in {rounds} rounds")
    return spellings.join(labels, ["term_id", "name"])


def entities(spellings: DataFrame) -> DataFrame:
    """(term_id, name, entity) for (term_id, name, n), each (term_id, name) once: spellings of one entity share
    its entity, which is the least of them.

    Null, blank and other spellings that name nobody are left out, as are rows with a null term.  A spelling that
    could mean two persons stays by itself.  An empty table gives an empty result.
    """
    term = spellings.schema["term_id"].dataType.simpleString()

    def one(family: pd.DataFrame) -> pd.DataFrame:
        found = resolve(list(zip(family["name"], family["n"])))
        first: dict[int, str] = {}
        for name, k in found.items():
            first[k] = min(first.get(k, name), name)
        rows = [(family["term_id"].iloc[0], name, first[k]) for name, k in found.items()]
        return pd.DataFrame(rows, columns=["term_id", "name", "entity"])

    clean = spellings.where("term_id IS NOT NULL AND name IS NOT NULL")
    return spread(families(clean), "term_id", "family").groupBy("term_id", "family").applyInPandas(one, f"term_id {term}, name string, entity string")


def spellings_of(*tables: DataFrame) -> DataFrame:
    """(term_id, name, n): the distinct spellings of several (term_id, name) tables with their counts."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.where(F.col("name").rlike(r"\S")).groupBy("term_id", "name").agg(F.count(F.lit(1)).alias("n"))


def found(votes: DataFrame, speakers: DataFrame) -> DataFrame:
    """(term_id, name_a, name_b): every pair of spellings of one entity within a term, the smaller first.

    Rows of one row_id count once; rows without a row_id cannot be told from one another, so each of them counts.
    """
    rows = votes.select("row_id", "term_id", F.col("member").alias("name"))
    members = rows.where("row_id IS NOT NULL").dropDuplicates(["row_id"]).unionByName(rows.where("row_id IS NULL")).drop("row_id")
    runners = speakers.select("term_id", F.col("runner_up.name").alias("name"))
    linked = cut(entities(spellings_of(members, runners)))
    a, b = (linked.select("term_id", "entity", F.col("name").alias(n)) for n in ("name_a", "name_b"))
    return a.join(b, ["term_id", "entity"]).where("name_a < name_b").select("term_id", "name_a", "name_b")
