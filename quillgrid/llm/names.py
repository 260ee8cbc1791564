"""Problem 4: variant spellings of names, by a pigeonhole segment join.

1. Each name is parsed by its type into a *core* (the letters that identify it), a *qualifier* that
   must agree (field of business, kind of technology or deal, drug code) and, for persons, a given
   name. Word order, case, accents, legal forms, titles and known short forms vanish here.
2. Cores are joined within an edit distance of k (insertion, deletion, substitution or swap of
   neighbours) in the same type and qualifier. Each core is cut into k + 1 segments; of two cores
   within k edits one segment stays whole unless a swap straddles a cut, so k + 1 cuttings with
   different cuts are used: each swap straddles the cut of at most one of them. Segments go into an
   inverted index keyed by (type, qualifier, length, cutting, segment, text); the other side looks
   up only the substrings whose shift is compatible with k edits on either side of the segment.
3. Candidates are verified with a banded edit distance; a plain distance that bounds it is tried
   first, in the JVM.
4. Links are closed to components. Persons are linked within one family name only where the given
   names agree; initials join a person only where exactly one person fits.

Only keys, never names of a whole type, meet in one task: a hot key is split by the skew join.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.operators.components import connected_components
from quillgrid.runtime import as_table

#: Cores of at least 10 letters may differ by two edits, of at least 6 by one.
TWO_EDITS, ONE_EDIT = 10, 6
#: Given names are shorter but lie within one family name.
GIVEN_EDITS = (7, 4)
#: The table of short forms is a dictionary of words, not data; more rows than this are refused.
MAX_FORMS = 100_000

# Legal forms and other words that carry no identity.
LEGAL = frozenset(
    "inc incorporated corp corporation ltd limited llc plc co company gmbh ag sa bv nv kk se spa srl oy ab as lp llp pty the group holding holdings of and".split()
)
TITLES = frozenset("dr prof professor mr mrs ms miss sir dame phd md msc bsc mba dphil jr sr ii iii iv mph rn pharmd dvm frcp".split())
DRUG_FORMS = frozenset(
    "tablet tablets injection injections sol solution hydrochloride hcl sc iv im oral capsule capsules cream gel spray infusion biosimilar free sodium acetate mesylate sulfate phosphate"
    " maleate tartrate potassium vial vials syringe pen patch drops er xr sr".split()
)
# Words for kinds of deals.
DEALS = {
    "merger": "merger combination tie tieup fusion amalgamation",
    "acquisition": "acquisition buyout takeover purchase",
    "collaboration": "collaboration collab partnership alliance cooperation",
    "license": "license licence licensing lic",
}
DEAL_REST = frozenset("agreement deal up out buy over take joint venture pact".split())
#: A code: up to five letters, perhaps with points, and three to six digits, with or without a joint.
_CODE = re.compile(r"(?<![a-z0-9])[a-z](?:\.?[a-z]){0,4}\.?[\s\-]*\d{3,6}[a-z]?(?![a-z0-9])")
_KIND = {w: k for k, words in DEALS.items() for w in words.split()}
#: A phrase is a kind of thing, and no name, when it stands beside at least so many different names, and beside this share of all names of its type.
KIND_NAMES, KIND_SHARE, KIND_WORDS = 10, 0.02, 4
#: Two given names are one when they are the only two of a family in so many families, and in this share of the rarer one's families.
ALIAS_FAMILIES, ALIAS_SHARE = 2, 0.5


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits from a to b up to ``most`` (most + 1 means more); a swap of neighbours is one edit, also of letters that came together by another edit.

    Only a band of width ``most`` around the diagonal is filled.
    """
    if a == b:
        return 0
    n, m, over = len(a), len(b), most + 1
    if abs(n - m) > most:
        return over
    rows: list[list[int]] = [[j if j <= most else over for j in range(m + 1)]]
    for i in range(1, n + 1):
        row, old, x = [over] * (m + 1), rows[i - 1], a[i - 1]
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(m, i + most) + 1):
            y = b[j - 1]
            v = old[j - 1] if x == y else min(old[j - 1], old[j], row[j - 1]) + 1
            if v > 1:  # x and y crossed: the nearest y before x in a, and x before y in b
                for k in range(max(1, i - most), i):
                    if a[k - 1] == y:
                        for h in range(max(1, j - most), j):
                            if b[h - 1] == x:
                                v = min(v, rows[k - 1][h - 1] + (i - k - 1) + 1 + (j - h - 1))
            row[j] = v if v < over else over
        if i > most and min(row) > most and min(old) > most:
            return over
        rows.append(row)
    return min(rows[n][m], over)


def plain(name: str) -> str:
    """Without accents, with plain dashes, quotes and blanks; case kept."""
    text = unicodedata.normalize("NFKD", name)
    text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"[‐-―−_]", "-", text).replace("’", "'").replace("®", "").replace("™", "")
    return " ".join(text.split())


def kindred(word: str, phrase: list[str]) -> bool:
    """Can a word stand for words of a phrase: misspelled, cut off, inflected, a part of one, or the initials of neighbours?"""
    bare = word[:-1] if len(word) > 3 and word.endswith("s") else word
    for w in phrase:
        shared = next((i for i, (x, y) in enumerate(zip(word, w)) if x != y), min(len(word), len(w)))
        if word == w or (len(word) >= 3 and shared == len(word)) or (shared >= 4 and shared * 5 >= 3 * min(len(word), len(w))):
            return True
        if (len(bare) >= 6 and bare in w) or (len(w) >= 6 and len(word) >= 5 and edit_distance(word, w, 2) <= 2):
            return True
    for i in range(len(phrase) - 1):  # initials: at least of two neighbours, then letters in their order
        rest = iter("".join(x[1:] if k == 0 else x for k, x in enumerate(phrase[i + 1 :])))
        if len(bare) >= 2 and bare[0] == phrase[i][0] and bare[1] == phrase[i + 1][0] and all(c in rest for c in bare[2:]):
            return True
    return False


def kinds_of(phrases: list[str]) -> list[list[str]]:
    """The kinds among phrases that come most frequent first: no part of a longer phrase, and no other way of writing one that came before."""
    found: list[list[str]] = []
    for phrase in phrases:
        words = phrase.split()
        longer = any(f" {phrase} " in f" {x} " and x != phrase for x in phrases)
        if not longer and not any(all(kindred(w, k) for w in words) for k in found):
            found.append(words)
    return found


class Parser:
    """Reads names; forms: (short form, full form, kind) of the table of short forms; kinds: the kinds of technologies, as words."""

    def __init__(self, forms: list[tuple[str, str, str]], kinds: list[list[str]] = ()):
        self.kinds = list(kinds)
        self.given: dict[str, str] = {}
        self.fields: dict[str, str] = {}
        for short, full, kind in forms:
            if short is None or full is None:
                continue
            short, full = (re.sub(r"[^a-z0-9 ]", "", plain(x).lower()).strip() for x in (short, full))
            if kind == "given_name":
                self.given[short] = full
            else:
                self.fields[short.replace(" ", "")] = full
                self.fields[full] = full
                if full.endswith("ies"):
                    self.fields[full[:-3] + "y"] = full
                elif full.endswith("s"):
                    self.fields.setdefault(full[:-1], full)
        self.full = sorted(set(self.fields.values()))
        self.known: dict[str, str | None] = {}

    def field(self, token: str, dotted: bool) -> str | None:
        """The field of business that a word means: as in the table, cut off with a point, or misspelled."""
        key = token + "." * dotted
        if key not in self.known:
            found = self.fields.get(token)
            if found is None and dotted and len(token) >= 3:
                found = next((w for w in self.full if w.startswith(token)), None)
            if found is None and len(token) >= 6:
                found = next((w for w in self.full if edit_distance(token, w, 2) <= 2), None)
            self.known[key] = found
        return self.known[key]

    def company(self, name: str) -> list[tuple[str, str, str]]:
        text = name.lower()
        inner = re.findall(r"\(([^()]*)\)", text)
        text = re.sub(r"\([^()]*\)", " ", text)
        field, core = "", []
        for part in inner:  # a field in brackets counts, an acronym does not
            word = re.sub(r"[^a-z]", "", part)
            if self.field(word, False):
                field = self.field(word, False)
        raw = re.findall(r"[a-z0-9&']+(?:\.[a-z]\b)*\.?", text.replace("-", " ").replace("/", " "))
        words = [(re.sub(r"[^a-z0-9]", "", x), x.endswith(".")) for x in raw]
        words = [x for x in words if x[0]]
        i = 0
        while i < len(words):
            w, dotted = words[i]
            pair = w + words[i + 1][0] if i + 1 < len(words) else ""
            if w in ("university", "univ", "universitat", "universite", "universidad") or (len(w) >= 8 and edit_distance(w, "university", 2) <= 2) or (w == "u" and i + 1 < len(words) and words[i + 1][0] == "of"):
                field = "university"
            elif w in LEGAL:
                pass
            elif pair in self.fields and pair not in (w, words[i + 1][0]):
                field, i = self.fields[pair], i + 1
            elif self.field(w, dotted) and (core or len(words) > i + 1 or inner):
                field = self.field(w, dotted)
            elif w.endswith("s") and name.lower().find(w[:-1] + "'s") >= 0:
                core.append(w[:-1])
            else:
                core.append(w)
            i += 1
        return [(field, "".join(core), "")]

    def person(self, name: str) -> list[tuple[str, str, str]]:
        if "," in name:
            left, _, right = name.partition(",")
            rest = [x for x in re.split(r"[\s,]+", right) if x]
            if all(re.sub(r"[^a-z]", "", x.lower()) in TITLES for x in rest):
                name, rest = left, []
            else:
                family = [x for x in left.split() if re.sub(r"[^a-z]", "", x.lower()) not in TITLES]
                return [self._person(" ".join(family), [x for x in rest if re.sub(r"[^a-z]", "", x.lower()) not in TITLES])]
        words = [x for x in name.split() if re.sub(r"[^a-z]", "", x.lower()) not in TITLES]
        if len(words) < 2:
            return [self._person(" ".join(words), [])]
        hyphened = [i for i, x in enumerate(words) if re.search(r"\w-\w", x)]
        shouted = [i for i, x in enumerate(words) if len(re.sub(r"[^A-Za-z]", "", x)) > 2 and x.upper() == x and "." not in x]
        if len(hyphened) == 1:
            at = hyphened[0]
        elif len(shouted) == 1:
            at = shouted[0]
        else:
            at = len(words) - 1
        return [self._person(words[at], words[:at] + words[at + 1 :])]

    def _person(self, family: str, given: list[str]) -> tuple[str, str, str]:
        core = re.sub(r"[^a-z0-9]", "", family.lower())
        first = ""
        for g in given:
            parts = [x for x in re.split(r"[^a-z]+", g.lower()) if x]
            if parts:
                first = parts[0]
                break
        return "", core, self.given.get(first, first)

    def drug(self, name: str) -> list[tuple[str, str, str]]:
        low = re.sub(r"\b\d+(?:\.\d+)?\s*(?:mg|mcg|ml|g)\b", " ", name.lower())
        code = _CODE.search(low)
        if code:
            core = re.sub(r"[^a-z0-9]", "", code[0])
            return [("code:" + core, core, "")]
        core = "".join(w for w in re.findall(r"[a-z0-9]+", low) if w not in DRUG_FORMS)
        return [("code:" + core if re.search(r"\d", core) else "", core, "")]

    def technology(self, name: str) -> list[tuple[str, str, str]]:
        words = [re.sub(r"[^a-z0-9]", "", w) for w in re.sub(r"'s\b", "", name.lower()).replace("-", " ").replace("(", " ").replace(")", " ").replace("/", " ").split()]
        words = [w for w in words if w and w not in LEGAL]
        found = [(sum(kindred(w, k) for w in words), -i) for i, k in enumerate(self.kinds)]
        votes, i = max(found, default=(0, 0))
        kind = self.kinds[-i] if votes else []
        return [(" ".join(kind), "".join(w for w in words if not kindred(w, kind)), "")]

    def deal(self, name: str) -> list[tuple[str, str, str]]:
        words = [w for w in re.findall(r"[a-z0-9]+", name.lower().replace("'s", "")) if w not in LEGAL]
        kind, core = "", []
        for w in words:
            known = _KIND.get(w) or next((k for v, k in _KIND.items() if len(v) >= 7 and len(w) >= 6 and edit_distance(w, v, 2) <= 2), None)
            if known:
                kind = known
            elif w not in DEAL_REST and not (len(w) >= 7 and edit_distance(w, "agreement", 2) <= 2):
                core.append(w)
        if len(core) == 2 and core[0] != core[1]:
            return [(kind, "".join(core), ""), (kind, "".join(reversed(core)), "")]
        return [(kind, "".join(core), "")]

    def parse(self, kind: str, name: str) -> list[tuple[str, str, str]]:
        """(qualifier, core, given name) for each reading of a name. A name without letters is read as itself."""
        text = plain(name)
        read = {"company": self.company, "person": self.person, "drug": self.drug, "technology": self.technology, "deal": self.deal}.get(kind)
        found = read(text) if read else [("", re.sub(r"[\W_]", "", text.lower()), "")]
        if not found[0][1]:
            return [("", "=" + " ".join(name.lower().split()), "")]
        return found


@lru_cache(maxsize=4096)
def _cuts(length: int, k: int) -> list[tuple[int, int, int, int]]:
    """(cutting, segment, start, length) of the k + 1 segments of a core in each of its k + 1 cuttings, whose cuts are all different."""
    base = [round(length * i / (k + 1)) for i in range(k + 2)]
    made = []
    for c, shift in zip(range(k + 1), (0, 1, -1)):
        at = [0, *(x + shift for x in base[1:-1]), length]
        made += [(c, s, x, y - x) for s, (x, y) in enumerate(zip(at, at[1:]))]
    return made


def edits_of(length: int, edits: tuple[int, int]) -> int:
    """Edits between two cores, by the length of the shorter one. edits: the least lengths for two edits and for one."""
    return 2 if length >= edits[0] else 1 if length >= edits[1] else 0


def segment_keys(block: str, core: str, edits: tuple[int, int], probe: bool) -> set[int]:
    """The hashes under which a core stands in the inverted index or, with ``probe``, is looked up.

    A key is (block, length, cutting, segment, text). Looked up are, for each shorter or equal length
    within k edits, the substrings whose shift is compatible with k edits on either side of the segment.
    Lengths that allow no edit have no keys.
    """
    keys, n = set(), len(core)
    for extra in range(3 if probe else 1):
        length = n - extra  # of the core in the index
        k = edits_of(length, edits)
        for c, s, start, size in _cuts(length, k) if k and extra <= k else ():
            for shift in range(-k, k + 1) if probe else (0,):
                x = start + shift
                if (not probe or abs(shift) + abs(extra - shift) <= k) and 0 <= x <= n - size:
                    keys.add(xxhash.xxh64_intdigest(f"{block}|{length}|{c}|{s}|{core[x : x + size]}") - (1 << 63))
    return keys


def learned_kinds(entities: DataFrame, of: str, name: str = "name", kind: str = "entity_type") -> list[list[str]]:
    """The phrases by which things of one type are classed, most frequent first, learned from all names of the type.

    A phrase of up to KIND_WORDS words is one when it stands beside many different names; a name stands
    beside the few ways of writing its own kind. What the driver reads is bounded: a name has no more
    phrases than KIND_WORDS times its words, so at most that many by 1 / KIND_SHARE can have their share.
    """
    words = F.filter(F.split(F.regexp_replace(F.lower(name), "'s\\b", ""), "[^a-z0-9]+"), lambda x: x != "")
    base = entities.where(F.lower(F.trim(F.col(kind))) == of).select(words.alias("w")).where("size(w) > 0").distinct()
    parts = F.expr(
        f"flatten(transform(sequence(1, least({KIND_WORDS}, size(w))), n -> transform(sequence(1, size(w) - n + 1), i ->"
        " struct(array_join(slice(w, i, n), ' ') as phrase, array_join(array_sort(concat(slice(w, 1, i - 1), slice(w, i + n, size(w)))), ' ') as rest))))"
    )
    beside = base.select(F.explode(parts).alias("p")).select("p.*").where("rest <> ''").distinct().groupBy("phrase").agg(F.count(F.lit(1)).alias("names"))
    least = base.agg(F.greatest(F.lit(KIND_NAMES), F.ceil(F.count(F.lit(1)) * KIND_SHARE)).alias("least"))
    rows = beside.join(least, F.col("names") >= F.col("least")).orderBy(F.desc("names"), "phrase").collect()
    return kinds_of([r.phrase for r in sorted(rows, key=lambda r: (-len(r.phrase.split()) * r.names, r.phrase))])


def parsed_names(entities: DataFrame, forms: DataFrame, key: str = "id", name: str = "name", kind: str = "entity_type") -> DataFrame:
    """(id, kind, qualifier, core, given), a row for each reading. Null names and null or blank types are dropped: they name nothing."""
    rows = forms.select("short_form", "full_form", "form_kind").limit(MAX_FORMS + 1).collect()
    if len(rows) > MAX_FORMS:
        raise ValueError(f"more than {MAX_FORMS} short forms")
    table = [tuple(r) for r in rows]
    kinds = learned_kinds(entities, "technology", name, kind)
    base = entities.select(F.col(key).alias("id"), F.lower(F.trim(F.col(kind))).alias("kind"), F.col(name).alias("name")).where("name is not null and trim(name) <> '' and kind <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser(table, kinds)
        for batch in batches:
            out = [(i, k, q, c, g) for i, k, n in zip(batch["id"], batch["kind"], batch["name"]) for q, c, g in parser.parse(k, n)]
            yield pd.DataFrame(out, columns=["id", "kind", "qualifier", "core", "given"], dtype=object)

    return base.mapInPandas(run, f"id {base.schema['id'].dataType.simpleString()}, kind string, qualifier string, core string, given string")


def similar_cores(cores: DataFrame, edits: tuple[int, int] = (TWO_EDITS, ONE_EDIT)) -> DataFrame:
    """(block, core_a, core_b): the different cores of one block within the allowed edits of the shorter one. Input (block, core), distinct."""
    # each core makes dozens of keys, so the cores are spread out first, however few bytes they are
    cores = cores.where(F.length("core") >= edits[1]).repartition(int(cores.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def keyed(probe: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keys = [np.fromiter(segment_keys(b, c, edits, probe), np.int64) for b, c in zip(batch["block"], batch["core"])]
                yield batch.assign(keys=pd.Series(keys, batch.index, dtype=object))

        return cores.select("block", "core").mapInPandas(run, "block string, core string, keys array<long>").select("block", "core", F.explode("keys").alias("k"))

    index = keyed(False).select(F.col("block").alias("block2"), F.col("core").alias("other"), "k")
    # a swap is one edit but two of Levenshtein's: within k edits that distance is at most 2 k
    most = F.when(F.least(F.length("core"), F.length("other")) >= edits[0], 4).otherwise(2)
    close = F.when(most == 4, F.levenshtein("core", "other", 4)).otherwise(F.levenshtein("core", "other", 2)) >= 0
    met = keyed(True).join(index, "k").where("block = block2 and core <> other and (length(core) > length(other) or core > other)").where(close)
    near = met.select("block", "core", "other").distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [edit_distance(a, b, k) <= k for a, b in zip(batch["core"], batch["other"]) for k in (edits_of(min(len(a), len(b)), edits),)]
            yield batch[keep].rename(columns={"core": "core_a", "other": "core_b"})

    return near.mapInPandas(verify, "block string, core_a string, core_b string")


def entity_classes(entities: DataFrame, forms: DataFrame, key: str = "id", name: str = "name", kind: str = "entity_type") -> DataFrame:
    """(id, class): entities of one type that name the same thing share a class. A class is named by a key, not by an id."""
    parsed = as_table(parsed_names(entities, forms, key, name, kind), "names")
    cores = parsed.select(F.concat_ws("|", "kind", "qualifier").alias("block"), "core").distinct()
    links = similar_cores(cores)
    # readings of one deal are one core: tie them
    readings = parsed.where("kind = 'deal'").groupBy("id").agg(F.first(F.concat_ws("|", "kind", "qualifier")).alias("block"), F.min("core").alias("core_a"), F.max("core").alias("core_b")).where("core_a <> core_b")
    edges = links.select("block", "core_a", "core_b").unionByName(readings.select("block", "core_a", "core_b"))
    node = lambda c: F.concat_ws("|", "block", c)
    parts = connected_components(edges.select(node("core_a").alias("src"), node("core_b").alias("dst")))
    full = parsed.groupBy("id").agg(F.min(F.struct(F.concat_ws("|", "kind", "qualifier", "core").alias("node"), "kind", "given")).alias("s")).select("id", "s.*")
    named = as_table(full.join(parts, "node", "left").select("id", "kind", "given", F.coalesce("component", "node").alias("family")), "families")
    others = named.where("kind <> 'person'").select("id", F.col("family").alias("class"))
    return others.unionByName(_persons(named.where("kind = 'person'")))


def _persons(named: DataFrame) -> DataFrame:
    """Split families of one family name by given name; initials join where one person fits."""
    nodes = named.select("family", "given").distinct()
    whole = nodes.where(F.length("given") > 1)

    close = similar_cores(whole.select(F.col("family").alias("block"), F.col("given").alias("core")), GIVEN_EDITS)
    # a given name that is cut short ("Zach"), or a part of one with a pet ending ("Dora"), stands in the whole one
    spelled = whole.select(F.col("family").alias("block"), F.col("given"))
    stems = spelled.select("block", F.col("given").alias("core_b"), F.explode(F.array_distinct(F.array("given", F.regexp_replace("given", "(?:ie|ey|[iyeao])$", "")))).alias("part")).where("length(part) >= 3")
    parts = "flatten(transform(sequence(3, length(given)), n -> transform(sequence(1, length(given) - n + 1), i -> substr(given, i, n))))"
    inside = spelled.where("length(given) > 3").select("block", F.col("given").alias("core_a"), F.explode(F.array_distinct(F.expr(parts))).alias("part"))
    cut = inside.join(stems, ["block", "part"]).where("core_a <> core_b and length(core_a) > length(core_b)").select("block", "core_a", "core_b").distinct()
    pairs = as_table(close.unionByName(cut).unionByName(_aliases(spelled)).distinct(), "given-pairs")
    node = lambda c, f="family": F.concat_ws("|", f, c)
    parts = connected_components(pairs.select(node("core_a", "block").alias("src"), node("core_b", "block").alias("dst")))
    known = whole.withColumn("node", node("given")).join(parts, "node", "left").select("family", "given", F.coalesce("component", "node").alias("class"))
    initial = nodes.where(F.length("given") <= 1)
    fits = (
        initial.join(known.select("family", "class", F.substring("given", 1, 1).alias("first")).distinct(), "family")
        .where("given = '' or first = given")
        .groupBy("family", "given")
        .agg(F.min("class").alias("only"), F.count_distinct("class").alias("n"))
    )
    # the first letter of the class's own name may differ from that of a spelling: count classes, not spellings
    placed = initial.join(fits, ["family", "given"], "left").select("family", "given", F.when(F.col("n") == 1, F.col("only")).otherwise(node("given")).alias("class"))
    return named.join(known.unionByName(placed), ["family", "given"]).select("id", "class")


def _aliases(named: DataFrame) -> DataFrame:
    """(block, core_a, core_b): the given names of one family that are used for each other elsewhere, however unlike they look.

    The evidence are the families with just two given names, one pair each: two names of different
    people meet in few of them by chance, a name and its pet form in most families that have it.
    """
    two = named.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min("given").alias("core_a"), F.max("given").alias("core_b")).where("n = 2").select("core_a", "core_b")
    both = two.groupBy("core_a", "core_b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= ALIAS_FAMILIES)
    each = two.select(F.explode(F.array("core_a", "core_b")).alias("given")).groupBy("given").agg(F.count(F.lit(1)).alias("families"))
    rarer = both.join(each.select(F.col("given").alias("core_a"), F.col("families").alias("fa")), "core_a").join(each.select(F.col("given").alias("core_b"), F.col("families").alias("fb")), "core_b")
    known = rarer.where(F.col("n") >= ALIAS_SHARE * F.least("fa", "fb")).select("core_a", "core_b")
    return named.withColumnRenamed("given", "core_a").join(known, "core_a").join(named.withColumnRenamed("given", "core_b"), ["block", "core_b"]).select("block", "core_a", "core_b")


def same_entity_pairs(entities: DataFrame, forms: DataFrame, key: str = "id", name: str = "name", kind: str = "entity_type") -> DataFrame:
    """(entity_id_a, entity_id_b): every two rows of one type that name the same thing, a < b."""
    classes = as_table(entity_classes(entities, forms, key, name, kind).distinct(), "classes")
    a, b = classes.select(F.col("id").alias("entity_id_a"), "class"), classes.select(F.col("id").alias("entity_id_b"), "class")
    return a.join(b, "class").where("entity_id_a < entity_id_b").select("entity_id_a", "entity_id_b")
