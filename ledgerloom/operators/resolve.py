"""Linking of actions to a site master: five levels of evidence, the first with a candidate decides."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address, rules, text
from ..session import cut
from . import joins

LEVELS = ("bbl", "bin", "address_exact", "address_range", "address_fuzzy")
ACCEPT, FLOOR = 96, 88  # fixed values: fuzzy scores that are accepted, and that are considered at all
GENERIC_NAMES = ("plaza", "tower", "towers", "building", "center", "centre", "house", "the", "park", "court", "place")


def evidence(actions: DataFrame, master: DataFrame, geocodes: DataFrame) -> DataFrame:
    """One row per action, address and borough to try: action_id, pos, query_key, borough, street, hn, geo_bbl, geo_bin, geo_status, inferred.

    An address without a borough is tried in every borough in which its exact key exists.
    """
    rows = actions.select("action_id", F.posexplode("candidates").alias("pos", "a"), F.col("borough").alias("action_borough"))
    known = F.coalesce(F.col("a.borough"), F.when(F.col("action_borough") != "", F.col("action_borough")))
    rows = rows.withColumn("borough", F.explode(F.when(known.isNotNull(), F.array(known)).otherwise(F.array(*map(F.lit, rules.BOROUGH_CODES)))))
    rows = with_streets(rows.withColumns({"inferred": known.isNull(), "written": F.col("a.street"), "number": F.col("a.number")}))
    rows = rows.withColumn("query_key", address.key_of(F.col("borough"), F.col("number"), F.col("street"))).filter("query_key is not null")
    keys = master.select(F.col("address_key").alias("query_key")).filter("query_key <> ''").distinct().hint("merge")
    rows = rows.filter("not inferred").unionByName(rows.filter("inferred").join(keys, "query_key", "left_semi"))
    geo = geocodes.select("query_key", F.col("bbl").alias("geo_bbl"), F.col("bin").alias("geo_bin"), F.col("status").alias("geo_status"))
    rows = rows.join(geo.hint("merge"), "query_key", "left").withColumn("geo_status", F.coalesce("geo_status", F.lit("not_geocoded")))
    ok = F.col("geo_status") == "ok"
    rows = rows.withColumns({"geo_bbl": F.when(ok, F.nullif("geo_bbl", F.lit(""))), "geo_bin": F.when(ok, F.nullif("geo_bin", F.lit("")))})
    rows = rows.withColumn("hn", address.house_number(F.col("number"), F.col("borough")))
    return rows.select("action_id", "pos", "query_key", "borough", "street", "hn", "geo_bbl", "geo_bin", "geo_status", "inferred", "number", "written")


def with_streets(rows: DataFrame) -> DataFrame:
    """rows(written, ...) with street, its canonical form; each way to write a street is worked out once, however many rows have it."""
    ways = cut(rows.select("written").distinct().withColumn("street", address.canonical_street(F.col("written"))))
    return rows.join(ways, "written", "left")


OUTCOME = {
    "pops_id": "", "match_method": "none", "match_confidence": "none", "match_score": 0.0, "match_status": "no_match", "match_candidates": "", "match_notes": "",
    "matched_address_key": "", "geocoded_bbl": "", "geocoded_bin": "", "geocode_status": "no_address",
}


def geocoded(proofs: DataFrame) -> DataFrame:
    """action_id, geocoded_bbl, geocoded_bin and geocode_status: what the geocoder said of an action's addresses, in their order, each once."""
    code = address.lookup({k: str(v) for k, v in rules.BOROUGH_CODES.items()}, F.col("borough"))
    seen = F.array_sort(F.collect_list(F.struct("pos", code.alias("code"), "geo_bbl", "geo_bin", "geo_status")))
    said = lambda c: F.array_join(F.array_distinct(F.filter(F.transform("seen", lambda x: x[c]), lambda v: v.isNotNull())), ";")
    per = proofs.groupBy("action_id").agg(seen.alias("seen"))
    return per.select("action_id", said("geo_bbl").alias("geocoded_bbl"), said("geo_bin").alias("geocoded_bin"), said("geo_status").alias("geocode_status"))


def told() -> list[Column]:
    """What an action gives to be linked by: its borough, identifiers, and addresses (candidates)."""
    ids = [F.col(f"identifiers.{k}").alias(k) for k in ("bbl", "bin", "block_lot")]
    return [F.col("borough"), F.struct(*ids).alias("identifiers"), F.transform("candidates", lambda a: F.struct(a["number"].alias("number"), a["street"].alias("street"), a["borough"].alias("borough"))).alias("candidates")]


def alike() -> Column:
    """The same for all actions that give the same evidence: a hash of `told`."""
    return F.unhex(F.md5(F.to_json(F.struct(*told())))).alias("alike")


def outcomes(actions: DataFrame, master: DataFrame, geocodes: DataFrame) -> DataFrame:
    """alike, OUTCOME and `look_for` (see `in_words`) of every evidence that actions(borough, identifiers, candidates) give, each once.

    So the pairs with sites and with the geocoder's answers, and the lists of them, grow with the different addresses and not with the
    actions that give them. Whoever joins this to actions should do so last: what follows would move the lists of each action.
    """
    each = cut(actions.select(*told()).distinct().select("*", alike()).withColumn("action_id", F.monotonically_increasing_id()))
    return cut(each.select("action_id", "alike").join(decide(each, evidence(each, master, geocodes), master).hint("merge"), "action_id").drop("action_id"))


def link(actions: DataFrame, master: DataFrame, geocodes: DataFrame) -> DataFrame:
    """`match` of all actions, from their addresses (candidates) and identifiers; actions is read twice.

    Actions that give the same evidence are matched once (`outcomes`). Only a building's name in the text is looked for in each.
    """
    found = outcomes(actions, master, geocodes)
    return in_words(actions.select("action_id", "enforcement_text", alike()).join(found.hint("merge"), "alike")).select("action_id", *OUTCOME)


def match(actions: DataFrame, proofs: DataFrame, master: DataFrame) -> DataFrame:
    """OUTCOME of every action: its site, how it was found and how surely, the candidates if there are several, notes, and the geocoder's word."""
    return in_words(actions.select("action_id", "enforcement_text").join(decide(actions, proofs, master).hint("merge"), "action_id")).select("action_id", *OUTCOME)


def in_words(found: DataFrame) -> DataFrame:
    """found with match_confidence and match_notes as they are if the building's name to `look_for` stands in enforcement_text."""
    named = F.coalesce(corroborated(F.col("look_for"), F.col("enforcement_text")), F.lit(False))
    note = F.concat("match_notes", F.lit("; building name '"), "look_for", F.lit("' in the text"))
    return found.withColumns({"match_confidence": F.when(named, "medium").otherwise(F.col("match_confidence")), "match_notes": F.when(named, note).otherwise(F.col("match_notes"))})


def decide(actions: DataFrame, proofs: DataFrame, master: DataFrame) -> DataFrame:
    """action_id, OUTCOME, and look_for: the building's name of the only site of a street that is alike, which the text may confirm.

    All levels are joins on equal keys; the lowest level with a candidate wins, and several sites there are ambiguous. A level sees only
    the actions that the levels before it left open, and ranges are compared once, however many actions and sites have them. What grows
    with the sites is never broadcast: the optimiser takes it for smaller than it is.
    """
    hn = F.when(F.col("hn").isNotNull(), F.struct(*[F.col(f"hn.{k}").alias(k) for k in ("kind", "low", "high")])).alias("hn")
    proofs = cut(proofs.select("action_id", "pos", "query_key", "borough", "street", hn, "geo_bbl", "geo_bin", "geo_status", "inferred", "written"))  # read by all levels
    site = cut(master.select("pops_id", "bbl", "bin", "address_key", "borough", "street_canonical", "hn_low", "hn_high", "building_name", "bin_is_placeholder")).hint("merge")
    ids = actions.select("action_id", "identifiers", "borough")
    code = address.lookup({k: str(v) for k, v in rules.BOROUGH_CODES.items()}, F.col("borough"))
    lots = F.transform("identifiers.block_lot", lambda x: F.concat(code, F.lpad(F.split_part(x, F.lit("/"), F.lit(1)), 5, "0"), F.lpad(F.split_part(x, F.lit("/"), F.lit(2)), 4, "0")))
    text_, blank = F.lit(True).alias("in_text"), F.lit("")
    written = ids.select("action_id", text_, F.explode(F.concat("identifiers.bbl", F.when(code.isNotNull(), lots).otherwise(F.array().cast("array<string>")))).alias("bbl"))
    bbls = written.unionByName(proofs.filter("geo_bbl is not null").select("action_id", (~text_).alias("in_text"), F.col("geo_bbl").alias("bbl")))
    bins = ids.select("action_id", text_, F.explode("identifiers.bin").alias("bin")).unionByName(proofs.filter("geo_bin is not null").select("action_id", (~text_).alias("in_text"), F.col("geo_bin").alias("bin")))

    def level(df: DataFrame, n: int, conf: Column, score: Column, note: Column, pos="pos", key=blank, building=None) -> DataFrame:
        pos = F.lit(pos) if isinstance(pos, int) else F.col(pos)
        building = F.lit(None).cast("string") if building is None else building
        return cut(decided(df.select("action_id", "pops_id", conf.alias("conf"), score.cast("double").alias("score"), pos.cast("int").alias("pos"), note.alias("note"), key.alias("key"), building.alias("building")), n))

    def left(df: DataFrame, found: DataFrame) -> DataFrame:
        return df.join(found.select("action_id").hint("merge"), "action_id", "left_anti")

    asked = proofs.groupBy("action_id").agg(F.collect_set("query_key").alias("asked"))
    by_bbl = bbls.join(site.filter("bbl <> ''").select("bbl", "pops_id", "address_key"), "bbl").drop("bbl").join(asked.hint("merge"), "action_id", "left")
    by_bbl = by_bbl.withColumn("agrees", F.coalesce(F.array_contains("asked", F.col("address_key")), F.lit(False)))
    own = Window.partitionBy("action_id")  # of one evidence: its sites, which `decided` puts into one list
    by_bbl = by_bbl.select("action_id", "pops_id", *[F.max(c).over(own).alias(to) for c, to in ((F.col("agrees"), "any"), (F.col("in_text"), "said"), (~F.col("in_text"), "looked_up"))])
    note = F.concat(F.lit("bbl via "), F.concat_ws("+", F.when(F.col("looked_up"), "geocode"), F.when(F.col("said"), "text")), F.when(F.col("any"), "; address agrees too").otherwise(""))
    found = [level(by_bbl, 1, F.lit("high"), F.when(F.col("any"), 1.0).otherwise(0.95), note, pos=0)]

    by_bin = left(bins, found[0]).join(site.filter("bin <> '' and not bin_is_placeholder").select("bin", "pops_id"), "bin").join(ids.select("action_id", (F.size("identifiers.bin") > 0).alias("worded")).hint("merge"), "action_id")
    found.append(level(by_bin, 2, F.lit("high"), F.lit(0.9), F.when(F.col("worded"), "bin via text").otherwise("bin via geocode"), pos=0))

    open_ = cut(left(left(proofs, found[0]), found[1]).drop("geo_bin"))
    exact = open_.join(site.select("pops_id", F.col("address_key").alias("query_key"), F.col("bbl").alias("site_bbl")), "query_key")
    differs = F.col("geo_bbl").isNotNull() & (F.col("site_bbl") != "") & (F.col("site_bbl") != F.col("geo_bbl"))
    score = F.when(differs, 0.6).otherwise(0.9)
    unsure = F.when(differs, "the geocoded bbl is not the site's").when(F.col("geo_status") != "ok", F.concat(F.lit("not confirmed by the geocoder ("), "geo_status", F.lit(")")))
    note = F.concat_ws("; ", unsure, F.when(F.col("inferred"), "borough inferred from the only site with this address"))
    conf = F.when(differs | F.col("inferred"), "medium").otherwise("high")
    found.append(level(exact, 3, conf, F.when(F.col("inferred"), F.least(score, F.lit(0.7))).otherwise(score), note, key=F.col("query_key")))

    numbered = left(open_, found[2]).filter("hn is not null")
    numbered = cut(numbered.select("action_id", "pos", "query_key", "borough", "street", "written", F.col("hn.kind").alias("kind"), F.col("hn.low").alias("low"), F.col("hn.high").alias("high")))
    on_street = site.select("pops_id", "borough", F.col("street_canonical").alias("street"), "hn_low", "hn_high")
    asked = ["borough", "street", "kind", "low", "high"]
    spans, held = cut(numbered.select(*asked).distinct()), cut(on_street.drop("pops_id").distinct())
    there = ["borough", "street", "hn_low", "hn_high"]
    pairs = joins.overlapping(spans, held, ["borough", "street"], ("low", "high"), ("hn_low", "hn_high")).filter("kind = 'range' or hn_low <> hn_high")
    ranges = numbered.drop("written").join(cut(pairs).hint("merge"), asked).join(on_street, there)
    found.append(level(ranges, 4, F.lit("medium"), F.lit(0.75), F.lit("number ranges overlap"), key=F.col("query_key")))

    numbered, there[1] = left(numbered, found[3]), "street_canonical"
    near = spans.join(similar_streets(spans.withColumn("hn", F.lit(1)), site), ["borough", "street"])
    pairs = cut(joins.overlapping(near, held.withColumnRenamed("street", "street_canonical"), ["borough", "street_canonical"], ("low", "high"), ("hn_low", "hn_high")))
    fuzzy = cut(numbered.join(pairs.hint("merge"), asked))
    top = fuzzy.groupBy("action_id").agg(F.max("ratio").alias("top"))
    winners = fuzzy.join(top.hint("merge"), "action_id").filter("ratio = top").join(site.select("pops_id", "borough", "street_canonical", "hn_low", "hn_high", "building_name"), there)
    conf = F.when((F.col("top") >= ACCEPT) & ~F.col("variant"), "medium").otherwise("low")
    kind = F.when(F.col("variant"), "one compass word more or less").otherwise(F.format_string("street name alike by %.0f", "top"))
    note = F.concat(kind, F.lit(" ('"), "written", F.lit("' ~ '"), "street_canonical", F.lit("')"))
    found.append(level(winners, 5, conf, F.col("top") / 100 * 0.8, note, key=F.col("query_key"), building=F.col("building_name")))

    at = found[0]
    for more in found[1:]:
        at = at.unionByName(more)
    every = actions.select("action_id").join(geocoded(proofs).hint("merge"), "action_id", "left").join(at.hint("merge"), "action_id", "left")
    nothing = F.when(F.col("geocode_status").isNull(), "no address to look up").otherwise("no site at this address")
    return every.withColumn("match_notes", F.coalesce("match_notes", nothing)).fillna(OUTCOME).select("action_id", *OUTCOME, "look_for")


def decided(at: DataFrame, level: int) -> DataFrame:
    """action_id, the columns of OUTCOME but the geocoder's, and look_for, from the candidates(action_id, pops_id, conf, score, pos, note, key, building) of a level."""
    seen, lead = F.array_sort(F.collect_list(F.struct("pos", "pops_id"))), F.struct("conf", "score", "note", "key", "building")
    out = at.groupBy("action_id").agg(F.array_distinct(F.transform(seen, lambda x: x["pops_id"])).alias("ids"), F.min_by(lead, F.struct("pos", "pops_id")).alias("lead"))
    one, method = F.size("ids") == 1, LEVELS[level - 1]
    several = F.concat(F.size("ids").cast("string"), F.lit(f" candidates at level {method}"))
    notes = F.when(one, F.col("lead.note")).otherwise(F.concat_ws("; ", F.nullif("lead.note", F.lit("")), several))
    return out.select(
        "action_id", F.when(one, F.get("ids", F.lit(0))).otherwise("").alias("pops_id"), F.lit(method).alias("match_method"),
        F.when(one, F.col("lead.conf")).otherwise("none").alias("match_confidence"), F.when(one, F.bround("lead.score", 3)).otherwise(0.0).alias("match_score"),
        F.when(one, "matched").otherwise("ambiguous").alias("match_status"), F.when(one, "").otherwise(F.array_join("ids", ";")).alias("match_candidates"),
        notes.alias("match_notes"), F.col("lead.key").alias("matched_address_key"), F.when(one, F.col("lead.building")).alias("look_for"),
    )


def similar_streets(proofs: DataFrame, site: DataFrame) -> DataFrame:
    """borough, street, street_canonical, ratio, variant: distinct street names of a borough that may mean the same.

    Numbers and compass words must agree, which makes them join keys, and the ratio must reach the floor; or one name is the
    other with one more compass word, which is a join on the shorter name.
    """
    keys = lambda c: [text.digits(F.col(c)), text.compass(F.col(c))]
    asked = proofs.filter("hn is not null").select("borough", "street").distinct()
    known = site.select("borough", "street_canonical").distinct()
    left = asked.withColumns(dict(zip(("digits", "compass"), keys("street"), strict=True)))
    right = known.withColumns(dict(zip(("digits", "compass"), keys("street_canonical"), strict=True)))
    same = cut(gram_pairs(left, right, ["borough", "digits", "compass"], "street", "street_canonical").filter("street <> street_canonical"))  # else the ratio is computed once a gram
    same = same.select("borough", "street", "street_canonical", text.indel_at_least(F.col("street"), F.col("street_canonical"), FLOOR).alias("ratio"), F.lit(False).alias("variant"))
    short = lambda c: F.regexp_replace(c, " (EAST|WEST|NORTH|SOUTH)$", "")
    longer = known.withColumn("street", short("street_canonical")).filter("street <> street_canonical").join(asked, ["borough", "street"])
    shorter = asked.withColumn("street_canonical", short("street")).filter("street <> street_canonical").join(known, ["borough", "street_canonical"])
    variants = longer.select("borough", "street", "street_canonical").unionByName(shorter.select("borough", "street", "street_canonical"))
    variants = variants.select("*", F.lit(88.0).alias("ratio"), F.lit(True).alias("variant"))
    return same.filter("ratio is not null").unionByName(variants)


def gram_pairs(left: DataFrame, right: DataFrame, keys: list[str], name: str, other: str, *, floor: float = FLOOR) -> DataFrame:
    """keys, name, other: pairs of equal keys that may reach an indel ratio of `floor`, and a few that don't.

    left and right have distinct rows of (keys, name) and (keys, other). A letter that goes spoils two pairs of neighbouring letters at
    most, and one that comes spoils one; the ratio bounds how many go and come, and so the part of a name's pairs that the other
    lacks. Of one pair more than that, one is shared, whichever are taken: the rarest within the keys, so that common words bring
    no candidates together. Lengths must allow for the ratio, too.
    """
    gone = 1 - floor / 100  # of both names' letters
    spoilt = 2 * gone * max(2 / (1 + gone), 1 / (1 - gone))  # pairs a letter of the name: if letters only go, or only come

    def grams(df: DataFrame, column: str) -> DataFrame:
        starts = F.sequence(F.lit(1), F.greatest(F.length(column) - 1, F.lit(1)))
        return df.select(*keys, F.col(column), F.explode(F.array_distinct(F.transform(starts, lambda k: F.substring(F.col(column), k, F.lit(2))))).alias("gram"))

    common = grams(right, other).groupBy(*keys, "gram").agg(F.count("*").alias("times"))

    def rare(df: DataFrame, column: str) -> DataFrame:
        ranked = grams(df, column).join(common, [*keys, "gram"], "left")
        own = ranked.groupBy(*keys, column).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram"))).alias("own"))
        wanted = F.floor(F.length(column) * F.lit(spoilt) + F.lit(1e-9)).cast("int") + 1
        return own.select(*keys, column, F.explode(F.slice("own", F.lit(1), wanted)["gram"]).alias("gram"))

    pairs = rare(left, name).join(rare(right, other), [*keys, "gram"])
    short, both = F.least(F.length(name), F.length(other)), F.length(name) + F.length(other)
    return pairs.filter(200 * short >= floor * both).select(*keys, name, other).distinct()


def _plain(name):
    return F.lower(F.trim(F.coalesce(name, F.lit(""))))


def corroborated(name, said):
    """Whether a building name of five characters or more, and not a generic word, stands in a text, without a letter beside it."""
    own = _plain(name)
    pattern = F.concat(F.lit(r"(?<![a-z])\Q"), F.replace(own, F.lit(r"\E"), F.lit("")), F.lit(r"\E(?![a-z])"))
    return (F.length(own) >= 5) & ~own.isin(*GENERIC_NAMES) & F.rlike(F.lower(said), pattern)


def names_in_text(texts: DataFrame, names: DataFrame, key: str, *, most: int = 4) -> DataFrame:
    """key, pops_id of every building name found in texts(key, said); names: pops_id, name.

    The join is on the name's part from its first run of letters to its last, or to the `most`-th, which must stand in the text from the
    begin of a run to the end of one, too; a name without letters is joined on its first five characters.
    """
    runs = lambda n: rf"(?:[a-z]+[^a-z]+){{{n - 1}}}[a-z]+"
    own = _plain(F.col("name"))
    known = names.filter((F.length(own) >= 5) & ~own.isin(*GENERIC_NAMES))
    parts = [F.nullif(F.regexp_extract(own, runs(n), 0), F.lit("")) for n in range(most, 0, -1)]
    known = known.withColumn("token", F.coalesce(*parts, F.substring(own, 1, 5)))
    said = F.lower("said")
    stands = [F.regexp_extract_all(said, F.lit(rf"(?<![a-z])(?=({runs(n)})(?![a-z]))"), F.lit(1)) for n in range(1, most + 1)]
    fives = F.regexp_extract_all(said, F.lit("(?=([^a-z]{5}))"), F.lit(1))  # every place where five characters are no letters
    tokens = texts.withColumn("token", F.explode(F.array_distinct(F.concat(*stands, fives))))
    return tokens.join(known.hint("merge"), "token").filter(corroborated(F.col("name"), F.col("said"))).select(key, "pops_id").distinct()


HEAD, MOST_HEADS, MOST_BYTES = 24, 500_000, 32 << 20  # letters of a passage in the automaton; bounds of what every task may hold


def passages_in_text(docs: DataFrame, items: DataFrame, *, before: int = 20, shown: int = 60, most_heads: int = MOST_HEADS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """item_id, doc_id, place (from 1), snippet of every passage of items(item_id, text) that a text of docs(doc_id, text) holds; its first place there.

    snippet: `shown` characters from `before` characters before the place, or from the text's begin.

    Passages of a checked size go to every task, as an automaton of their first letters that reads each text once; where one
    of these stands the whole passage is compared. Larger tables of passages are joined on hashes of tokens (`passages_by_tokens`).
    """
    known = cut(items.filter("text <> ''").select(F.col("item_id").cast("long").alias("item_id"), "text"))
    n, size = known.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if n > most_heads or size > most_bytes:
        return passages_by_tokens(docs, known, before=before, shown=shown)
    held = docs.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in known.collect()])  # n and size are checked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[str, list] = {}
        for item, passage in held.value:
            heads.setdefault(passage[:HEAD], []).append((item, passage))
        automaton = ahocorasick.Automaton()
        for head, own in heads.items():
            automaton.add_word(head, (len(head), own))
        automaton.make_automaton()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["body"], strict=True):
                text, seen = text.as_py(), set()
                for end, (k, own) in automaton.iter(text) if heads else ():
                    begin = end + 1 - k
                    for item, passage in own:
                        if (item, passage) not in seen and text.startswith(passage, begin):
                            seen.add((item, passage))
                            start = max(begin + 1 - before, 1) - 1
                            rows.append((item, doc, begin + 1, text[start : start + shown]))
            values = [pa.array([r[k] for r in rows], pa.string() if k == 3 else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(values, ["item_id", "doc_id", "place", "snippet"])

    body = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("body"))
    return body.mapInArrow(run, "item_id long, doc_id long, place long, snippet string")


def passages_by_tokens(docs: DataFrame, items: DataFrame, *, before: int = 20, shown: int = 60, most: int = 4) -> DataFrame:
    """passages_in_text for any number of passages, by a join.

    All but the first and last blank-separated token of a passage are tokens of the text, too, so the join is on the hash of up to
    `most` tokens after the first, for the numbers of tokens that occur; a passage of one or two tokens is joined on its first
    characters, as many as all such passages have. Candidates are then held against the whole passage.
    """
    tokens = lambda c: F.split(c, " ", -1)
    n = F.greatest(F.lit(0), F.least(F.lit(most), F.size(tokens(F.col("text"))) - 2))
    known = items.select("item_id", F.col("text").alias("passage"), n.alias("n"), F.xxhash64(F.array_join(F.slice(tokens(F.col("text")), F.lit(2), n), " ")).alias("key")).filter("passage <> ''")
    own = docs.select("doc_id", F.col("text").alias("body")).filter("body is not null")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())  # of 0 to `most`
    pairs = docs.sparkSession.createDataFrame([], own.select("doc_id").schema).join(items.select("item_id").limit(0))
    if any(lengths):
        grams = own.select("doc_id", tokens(F.col("body")).alias("w")).withColumn("n", F.explode(F.array(*[F.lit(k) for k in lengths if k])))
        starts = F.filter(F.sequence(F.lit(1), F.size("w")), lambda k: k + F.col("n") - 1 <= F.size("w"))
        grams = grams.select("doc_id", "n", F.explode(F.array_distinct(F.transform(starts, lambda k: F.xxhash64(F.array_join(F.slice("w", k, F.col("n")), " "))))).alias("key"))
        pairs = pairs.unionByName(grams.join(known.filter("n > 0").select("item_id", "n", "key"), ["n", "key"]).select("doc_id", "item_id").distinct())
    if 0 in lengths:
        short = known.filter("n = 0")
        size = short.agg(F.min(F.length("passage")).alias("size"))
        heads = own.join(size, F.col("size").isNotNull())  # one row
        heads = heads.select("doc_id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("body"), F.lit(1))), lambda k: F.substring("body", k, F.col("size"))))).alias("head"))
        few = short.join(size, F.lit(True)).select("item_id", F.substring("passage", F.lit(1), F.col("size")).alias("head"))
        pairs = pairs.unionByName(heads.join(few, "head").select("doc_id", "item_id").distinct())
    found = pairs.join(known.select("item_id", "passage"), "item_id").join(own, "doc_id").withColumn("place", F.instr("body", F.col("passage")).cast("long"))
    snippet = F.expr(f"substring(body, greatest(place - {before}, 1), {shown})").alias("snippet")
    return found.filter("place > 0").select("item_id", "doc_id", "place", snippet).distinct()


def relation(tier, matched):
    """Relation of an action to sites, from its wording tier and whether it is matched."""
    worded = tier.isin("strong", "moderate")
    return (
        F.when(worded & matched, "pops_text_and_property_match").when(worded, "pops_text_only").when(matched, "property_match_only")
        .when(tier == "weak", "weak_keyword_only").otherwise("none")
    )


def overlay(actions: DataFrame, decisions: DataFrame) -> DataFrame:
    """review_status and the site after the last decision of each action; the relation stays as it was.

    actions: enforcement_id, pops_relation, match_confidence, match_status, pops_id, match_method. decisions: enforcement_id, seq,
    decision, pops_id, note.
    """
    return decide_on(actions.join(last_decisions(decisions), "enforcement_id", "left"))


def last_decisions(decisions: DataFrame) -> DataFrame:
    """enforcement_id and d(decision, to, note), the last decision of each action."""
    return decisions.groupBy("enforcement_id").agg(F.max_by(F.struct("decision", F.col("pops_id").alias("to"), "note"), "seq").alias("d"))


def decide_on(df: DataFrame) -> DataFrame:
    """`overlay` of actions that have their last decision d, or NULL."""
    word = F.lower(F.trim(F.coalesce("d.decision", F.lit(""))))
    status = F.when((F.col("pops_relation") == "pops_text_and_property_match") & (F.col("match_confidence") == "high"), "auto_confirmed")
    status = status.when((F.col("pops_relation") != "none") | (F.col("match_status") == "ambiguous"), "needs_review").otherwise("")
    yes = word.isin("confirm", "confirmed", "reassign")
    moved = yes & (F.coalesce("d.to", F.lit("")) != "")
    return df.withColumns(
        {
            "review_status": F.when(yes, "reviewed_confirmed").when(word.isin("reject", "rejected"), "reviewed_rejected").otherwise(status),
            "pops_id": F.when(moved, F.col("d.to")).otherwise(F.col("pops_id")), "match_method": F.when(moved, "manual").otherwise(F.col("match_method")),
            "match_confidence": F.when(moved, "high").otherwise(F.col("match_confidence")), "match_status": F.when(moved, "matched").otherwise(F.col("match_status")),
            "review_note": F.coalesce("d.note", F.lit("")),
        }
    ).drop("d")
