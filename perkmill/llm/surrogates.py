"""PII surrogates: detected entities get keyed replacements of the same type and format.

Only DataFrame functions are used. A replacement follows from a secret key and the normalised
entity, so mentions of one entity agree in all texts (coreference), whatever their spelling:
telephone numbers are compared by their last ten digits, cards by their digits, mail addresses
without case, names by family name and by gender with the whole name.

All but names are replaced by a keyed permutation of their format's space (a Feistel network
whose rounds move every letter or digit on within its own alphabet), so two entities cannot get
one replacement. What is left to check are replacements that are themselves somebody's entity:
these are drawn again under another key. From the third draw on addresses, keys and secrets get
letters added, so that a full space (all 26 one-letter addresses of a domain) is left; in a full
space of fixed length an entity keeps its first draw, which is distinct from all others. Family
names are syllables and may collide; of several with one replacement one keeps it, the others
are drawn again with a syllable more.

| type | kept | replaced |
|---|---|---|
| email | top-level domain, punctuation, case | letters and digits; equal domains stay equal |
| phone | format, country code | last ten digits |
| card | format, whether the check digit is right | digits |
| ssn | format | digits |
| iban | format, country, whether the check digits are right | letters and digits |
| ip | format | all four numbers |
| key, secret | name of the setting, length, case, digits | letters and digits |
| name | title, possessive | given name of the same gender and script, family name |

Where a name was found by its title, its given and family name are replaced wherever they stand
in that text, by the same surrogates; if two persons share a word, the first of them counts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perkmill.llm.tables import Scratch, read_table

DEFAULT_KEY = "replace this key in production"
MOST_DRAWS = 12
# The draw from which addresses, keys and secrets get longer, by one letter a draw.
LONGER_FROM = 3
# Parts whose replacements have the length of the original at every draw.
FIXED_LENGTH = ("phone", "card", "ssn", "iban", "ip")
# Up to so many redrawn parts are looked up in a literal, more of them are joined.
MOST_LITERALS = 500

_MALE_TITLES = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Don|господин|кύριος"
_FEMALE_TITLES = "Mrs|Ms|Miss|Madam|Lady|Frau|Fräulein|Madame|Mme|Mlle|Señora|Señorita|Sra|Doña|госпожа|κυρία"
_WORD = r"\p{Lu}[\p{L}'’-]+"
PATTERNS = {
    "secret": r"\b(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_\-.!@#$%^&*]{6,}",
    "key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp|gho|xoxb|xoxp|sk)[_-][A-Za-z0-9_-]{16,}",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b(?<=\d.{0,40})",
    "card": r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\d)",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?![\d-])|(?<![\w.])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\d)",
    "name": rf"\b(?:{_MALE_TITLES}|{_FEMALE_TITLES}|Dr|Prof)\b\.? {_WORD}(?: {_WORD})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

_GIVEN = {
    ("m", "latin"): "Adam Anton Bruno Carl Daniel David Emil Felix Hugo Ivan Jonas Karl Leon Lucas Marco Martin Max Oscar Pablo Paul Peter Simon Thomas Victor",
    ("f", "latin"): "Alice Anna Bella Carla Clara Diana Elena Emma Eva Flora Hanna Ida Irene Julia Laura Lea Lena Maria Marta Nina Olga Paula Rosa Sofia",
    ("m", "cyrillic"): "Андрей Антон Борис Виктор Денис Егор Иван Кирилл Максим Никита Олег Павел",
    ("f", "cyrillic"): "Алла Анна Вера Дарья Елена Ирина Мария Нина Ольга Полина Софья Юлия",
    ("m", "greek"): "Ανδρέας Γιώργος Δημήτρης Ηλίας Κώστας Μάριος Νίκος Πέτρος",
    ("f", "greek"): "Άννα Ελένη Ειρήνη Ζωή Κατερίνα Μαρία Νίκη Σοφία",
}
_SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi fo ga go ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe po ra re ri ro sa se si so ta te ti to va ve vi vo",
    "cyrillic": "ба бе би бо ва ве ви во да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то",
    "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το",
}


def entity_type(entity: Column) -> Column:
    """The type of an extracted entity: the first pattern that covers all of it."""
    out = None
    for name, pattern in PATTERNS.items():
        covers = entity.rlike(rf"^(?:{pattern})$")
        out = F.when(covers, name) if out is None else out.when(covers, name)
    return out.otherwise("secret")


def _digits(entity: Column) -> Column:
    return F.regexp_replace(entity, r"\D", "")


_SECRET_HEAD = r"^((?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)"
_NAME_HEAD = r"^(\S+ )"
_POSSESSIVE = r"['’]s$"
_BARE = r"(?<![\p{L}'’-])\p{Lu}[\p{L}'’-]+"


def normalised(kind: Column, entity: Column) -> Column:
    """What two mentions of one entity have in common."""
    return (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "phone", F.right(_digits(entity), F.lit(10)))
        .when(kind.isin("card", "ssn"), _digits(entity))
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "secret", F.regexp_replace(entity, _SECRET_HEAD, ""))
        .otherwise(entity))


def _gender(entity: Column) -> Column:
    return F.when(entity.rlike(rf"^(?:{_FEMALE_TITLES})\b"), "f").when(entity.rlike(rf"^(?:{_MALE_TITLES})\b"), "m").otherwise("x")


def _stream(key: str, kind: Column, norm: Column, draw: Column) -> Column:
    """128 hexadecimal digits that follow from the key, the entity and the draw."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, norm, draw.cast("string"))
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f+")), 256))


def _number(stream: Column, k: Column) -> Column:
    """The k-th number (from 0) of 0 to 65535 in the stream."""
    return F.conv(F.substr(stream, (k % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _characters(text: Column, one) -> Column:
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _moved_on(text: Column, stream: Column) -> Column:
    """Every ASCII letter and digit moved on in its own alphabet by a number of the stream."""
    def one(c: Column, i: Column) -> Column:
        code, by = F.ascii(c), _number(stream, i)
        out = None
        for first, size in ((48, 10), (65, 26), (97, 26)):
            inside, moved = code.between(first, first + size - 1), F.char((code - first + by) % size + first)
            out = F.when(inside, moved) if out is None else out.when(inside, moved)
        return out.otherwise(c)

    return _characters(text, one)


def _rounds(first: Column, second: Column, seed: Column, moved, joined) -> Column:
    """Four Feistel rounds: each half in turn is moved by numbers drawn from the other one."""
    def turn(halves: Column, k: Column) -> Column:
        stream = F.sha2(F.concat_ws("\x1f", seed, k.cast("string"), halves["b"].cast("string")), 512)
        return F.struct(halves["b"].alias("a"), _let(stream, lambda s: moved(halves["a"], s)).alias("b"))

    return F.aggregate(
        F.array(*[F.lit(k) for k in range(4)]), F.struct(first.alias("a"), second.alias("b")), turn, lambda h: joined(h["a"], h["b"]))


def permuted(text: Column, seed: Column) -> Column:
    """A permutation of the texts of one format (letters, capitals, digits and the rest in place)."""
    half = (F.length(text) / 2).cast("int")
    return _rounds(F.substr(text, F.lit(1), half), F.substr(text, half + 1), seed, _moved_on, F.concat)


def permuted_ip(address: Column, seed: Column) -> Column:
    """A permutation of all IPv4 addresses."""
    def pair(k: int) -> Column:
        numbers = F.split(address, r"\.")
        return numbers[k].cast("int") * 256 + numbers[k + 1].cast("int")

    def octets(number: Column) -> Column:
        return F.concat_ws(".", F.shiftright(number, 8).cast("string"), (number % 256).cast("string"))

    return _rounds(
        pair(0), pair(2), seed, lambda half, stream: (half + _number(stream, F.lit(0))) % 65536, lambda a, b: F.concat_ws(".", octets(a), octets(b)))


def _digit_values(digits: Column) -> Column:
    return F.transform(F.split(digits, ""), lambda c: F.ascii(c) - 48)


def luhn(body: Column) -> Column:
    """The check digit that makes a card number of ``body``."""
    doubled = lambda d, i: F.when((F.length(body) - i) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    return (10 - F.aggregate(F.transform(_digit_values(body), doubled), F.lit(0), lambda a, d: a + d) % 10) % 10


def iban_check(country: Column, account: Column) -> Column:
    """The check number that makes an IBAN of ``account``."""
    def more(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return 98 - F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), more)


def _card(digits: Column, seed: Column) -> Column:
    """A right check digit stays right, a wrong one stays wrong by as much."""
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    wrong_by = F.right(digits, F.lit(1)).cast("int") - luhn(body)
    return _let(permuted(body, seed), lambda b: F.concat(b, ((luhn(b) + wrong_by + 10) % 10).cast("string")))


def _iban(iban: Column, seed: Column) -> Column:
    country, account = F.substring(iban, 1, 2), F.substr(iban, F.lit(5))
    wrong_by = F.substring(iban, 3, 2).cast("int") - iban_check(country, account)
    return _let(permuted(account, seed), lambda a: F.concat(
        country, F.lpad(((iban_check(country, a) + wrong_by + 100) % 100).cast("string"), 2, "0"), a))


def _filled(text: Column, new: Column, kept: str) -> Column:
    """``text`` with the characters of ``new`` in the last places that ``kept`` does not match."""
    left = lambda c: F.length(F.regexp_replace(c, kept, ""))

    def fill(fresh: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            place = F.length(fresh) - left(text) + left(F.substr(text, F.lit(1), i + 1))
            return F.when(c.rlike(kept) | (place < 1), c).otherwise(F.substr(fresh, place, F.lit(1)))

        return _characters(text, one)

    return _let(new, fill)


def _cased(new: Column, as_in: Column) -> Column:
    """``new`` with capitals where ``as_in`` has them."""
    return _characters(new, lambda c, i: F.when(F.ascii(F.substr(as_in, i + 1, F.lit(1))).between(65, 90), F.upper(c)).otherwise(c))


def _longer(text: Column, draw: Column) -> Column:
    return F.concat(text, F.repeat(F.lit("a"), F.greatest(draw - (LONGER_FROM - 1), F.lit(0))))


def _mail(entity: Column, key: str, draw: Column) -> Column:
    local, domain, top = (F.regexp_extract(entity, p, 1) for p in (r"^([^@]*)@", r"@(.*)\.[^.]*$", r"(\.[^.]*)$"))
    host = F.lower(F.concat(domain, top))
    return F.concat(
        _cased(permuted(_longer(F.lower(local), draw), _stream(key, F.lit("email"), host, draw)), local), F.lit("@"),
        _cased(permuted(F.lower(domain), _stream(key, F.lit("domain"), F.lit(""), F.lit(0))), domain), top)


def _words(listed: str) -> Column:
    return F.array(*[F.lit(w) for w in listed.split()])


def _syllables(script: str, stream: Column, count: Column) -> Column:
    listed = _words(_SYLLABLES[script])
    return F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(16)), lambda k: F.when(k <= count, F.element_at(listed, _number(stream, k) % F.size(listed) + 1)).otherwise("")), "")


def _script(entity: Column) -> Column:
    return F.when(entity.rlike(r"\p{IsCyrillic}{2}$"), "cyrillic").when(entity.rlike(r"\p{IsGreek}{2}$"), "greek").otherwise("latin")


def _family(entity: Column, stream: Column, draw: Column) -> Column:
    """Four syllables of the script, one more with each draw."""
    out = None
    for script in _SYLLABLES:
        made = F.initcap(_syllables(script, stream, draw + 4))
        out = F.when(_script(entity) == script, made) if out is None else out.when(_script(entity) == script, made)
    return out


def _given_name(entity: Column, stream: Column, draw: Column) -> Column:
    """A listed given name of the gender and script, with a syllable added at each further draw."""
    gender = F.when(_gender(entity) == "x", F.when(_number(stream, F.lit(20)) % 2 == 0, "f").otherwise("m")).otherwise(_gender(entity))
    out = None
    for (g, script), listed in _GIVEN.items():
        matches = (gender == g) & (_script(entity) == script)
        made = F.concat(F.element_at(_words(listed), _number(stream, F.lit(0)) % len(listed.split()) + 1), _syllables(script, stream, draw))
        out = F.when(matches, made) if out is None else out.when(matches, made)
    return out


def parts(kind: Column, entity: Column) -> Column:
    """array<struct<kind, norm, entity>>: what of an entity is replaced by itself.

    A name has a family part and, if it has two words, a given part; all others are one part.
    """
    part = lambda k, norm, e: F.struct(k.alias("kind"), norm.alias("norm"), e.alias("entity"))
    name = F.regexp_replace(F.regexp_replace(entity, _NAME_HEAD, ""), _POSSESSIVE, "")
    family = F.regexp_extract(name, r"(\S+)$", 1)
    given = part(F.lit("given"), F.concat(_gender(entity), F.lit(":"), F.lower(name)), F.regexp_replace(entity, _POSSESSIVE, ""))
    names = F.when(name.contains(" "), F.array(given)).otherwise(F.slice(F.array(given), 1, 0))
    return F.when(kind == "name", F.concat(names, F.array(part(F.lit("family"), F.lower(family), family)))).otherwise(
        F.array(part(kind, normalised(kind, entity), entity)))


def surrogate(key: str, part: Column, draw: Column) -> Column:
    """The replacement of one part of an entity."""
    kind, norm, entity = part["kind"], part["norm"], part["entity"]
    own = F.when(kind.isin("family", "given"), norm).otherwise("")

    def made(stream: Column) -> Column:
        return (
            F.when(kind == "email", _mail(entity, key, draw))
            .when(kind.isin("phone", "ssn"), _filled(entity, permuted(norm, stream), r"\D"))
            .when(kind == "card", _filled(entity, _card(norm, stream), r"\D"))
            .when(kind == "iban", _filled(entity, _iban(norm, stream), " "))
            .when(kind == "ip", permuted_ip(entity, stream))
            .when(kind == "family", _family(entity, stream, draw))
            .when(kind == "given", _given_name(entity, stream, draw))
            .when(kind == "secret", F.concat(F.regexp_extract(entity, _SECRET_HEAD, 1), permuted(_longer(norm, draw), stream)))
            .otherwise(F.concat(F.substring(entity, 1, 4), permuted(_longer(F.substr(entity, F.lit(5)), draw), stream))))

    return _let(_stream(key, kind, own, draw), made)


def _made_norm(kind: Column, norm: Column, made: Column) -> Column:
    """What a replacement would be compared by if it were an entity."""
    return (
        F.when(kind == "family", F.lower(made))
        .when(kind == "given", F.concat(F.substring(norm, 1, 2), F.lower(made), F.regexp_extract(norm, r"( \S+)$", 1)))
        .otherwise(normalised(kind, made)))


def entities(docs: DataFrame) -> DataFrame:
    """(kind, norm, entity): every distinct part of an entity in the texts, with one spelling."""
    found = docs.select(F.explode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("entity")).distinct()
    typed = found.withColumn("kind", entity_type(F.col("entity")))
    return typed.select(F.inline(parts(F.col("kind"), F.col("entity")))).groupBy("kind", "norm").agg(F.min("entity").alias("entity"))


def redrawn(found: DataFrame, key: str, scratch: Scratch) -> DataFrame | None:
    """(kind, norm, draw) of parts whose first replacement cannot stay; None if there are none.

    Drawn again are replacements that are entities of the corpus, and all but the earliest drawn
    (then smallest) of several with one replacement. A part of fixed length that finds no free
    place goes back to its first draw: only its owner can have it, as replacements made later
    are never entities of the corpus.
    """
    def drawn(rows: DataFrame) -> DataFrame:
        made = rows.withColumn("made", surrogate(key, F.struct("kind", "norm", "entity"), F.col("draw")))
        return made.withColumn("made", _made_norm(F.col("kind"), F.col("norm"), F.col("made")))

    taken = scratch.store(drawn(found.select("kind", "norm", "entity", F.lit(0).alias("draw"))))
    for _ in range(MOST_DRAWS):
        owners = taken.groupBy("kind", "made").agg(F.min(F.struct("draw", "norm"))["norm"].alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = owners.where("n > 1").select("kind", "made", "owner")
        real = taken.select("kind", F.col("norm").alias("made"))
        twice = taken.join(shared, ["kind", "made"]).where("norm <> owner").select("kind", "norm")
        known = taken.join(real, ["kind", "made"], "left_semi").select("kind", "norm")
        wrong = scratch.store(twice.unionByName(known).distinct())
        if wrong.isEmpty():
            break
        again = drawn(taken.join(wrong, ["kind", "norm"], "left_semi").withColumn("draw", F.col("draw") + 1).drop("made"))
        following = scratch.store(taken.join(wrong, ["kind", "norm"], "left_anti").unionByName(again))
        scratch.drop(taken)
        taken = following
    else:
        if not wrong.where(~F.col("kind").isin(*FIXED_LENGTH)).isEmpty():
            raise RuntimeError("replacements still collide after all draws")
        taken = taken.join(wrong, ["kind", "norm"], "left_anti")
    moved = taken.where("draw > 0").select("kind", "norm", "draw")
    return None if moved.isEmpty() else moved


def replace(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with surrogates in text, and (kind, surrogate) of each mention in ``_surrogates``.

    A NULL text stays NULL and a text without entities stays as it is. All other columns are
    passed through; a column named _surrogates would be replaced. Rows are independent: ids
    may repeat or be NULL.
    """
    scratch = Scratch(docs.sparkSession, "surrogates")
    moved = redrawn(scratch.store(entities(docs)), key, scratch)
    names = [c for c in docs.columns if c != "_surrogates"]
    rows = docs.select(*names, F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("_found"))
    rows = rows.withColumn("_found", F.transform("_found", lambda e: F.struct(e.alias("entity"), entity_type(e).alias("kind"))))
    rows = rows.withColumn("_found", F.transform("_found", lambda f: f.withField("parts", parts(f["kind"], f["entity"]))))
    rows, draw_of = _draws(rows, moved)

    def replaced(f: Column) -> Column:
        made = F.transform(f["parts"], lambda p: F.struct(p["kind"].alias("kind"), p["entity"].alias("entity"), surrogate(key, p, draw_of(p)).alias("made")))
        return F.struct(f["kind"].alias("kind"), f["entity"].alias("entity"), made.alias("parts"))

    def joined(f: Column) -> Column:
        made = F.concat_ws(" ", F.transform(f["parts"], lambda p: p["made"]))
        name = F.concat(F.regexp_extract(f["entity"], _NAME_HEAD, 1), made, F.regexp_extract(f["entity"], f"({_POSSESSIVE})", 1))
        return F.struct(f["kind"].alias("kind"), F.when(f["kind"] == "name", name).otherwise(made).alias("surrogate"))

    some = F.size("_found") > 0
    rows = rows.withColumn("_found", F.transform("_found", replaced))
    rows = rows.withColumn("_surrogates", F.when(some, F.transform("_found", joined)))
    of_names = F.flatten(F.transform(F.filter("_found", lambda f: f["kind"] == "name"), lambda f: f["parts"]))
    rows = rows.withColumn("_names", F.transform(of_names, lambda p: F.struct(
        F.when(p["kind"] == "given", F.regexp_extract(p["entity"], r"(\S+) \S+$", 1)).otherwise(p["entity"]).alias("word"), p["made"].alias("made"))))
    gaps = F.split("text", ANY)
    text = F.array_join(F.transform(gaps, lambda g, i: F.concat(
        F.when(F.size("_names") > 0, _later_mentions(g)).otherwise(g),
        F.when(i < F.size("_surrogates"), F.get(F.col("_surrogates"), i)["surrogate"]).otherwise(""))), "")
    return rows.select(*[F.when(some, text).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in names], "_surrogates")


def _later_mentions(gap: Column) -> Column:
    """Text between entities with the words of the text's names replaced."""
    def one(word: Column) -> Column:
        stem = F.regexp_replace(word, _POSSESSIVE, "")
        return F.concat(F.coalesce(F.get(F.col("_names.made"), (F.array_position(F.col("_names.word"), stem) - 1).cast("int")), stem), F.regexp_extract(word, f"({_POSSESSIVE})", 1))

    return _let(F.regexp_extract_all(gap, F.lit(_BARE), F.lit(0)), lambda words: F.array_join(F.transform(
        F.split(gap, _BARE), lambda g, i: F.concat(g, F.when(i < F.size(words), one(F.get(words, i))).otherwise(""))), ""))


def _draws(rows: DataFrame, moved: DataFrame | None):
    """``rows`` and a function that gives the draw of a part."""
    if moved is None:
        return rows, lambda p: F.lit(0)
    few = moved.limit(MOST_LITERALS + 1).collect()
    label = lambda p: F.concat_ws("\x1f", p["kind"], p["norm"])
    if len(few) <= MOST_LITERALS:
        listed = F.from_json(F.lit(json.dumps({f"{r.kind}\x1f{r.norm}": r.draw for r in few})), "map<string,int>")
        return rows, lambda p: F.coalesce(F.element_at(listed, label(p)), F.lit(0))
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    wanted = numbered.select("_row", F.explode(F.flatten("_found.parts")).alias("p")).select("_row", "p.kind", "p.norm").distinct()
    pairs = F.struct(F.concat_ws("\x1f", "kind", "norm"), "draw")
    found = wanted.join(moved, ["kind", "norm"]).groupBy("_row").agg(F.map_from_entries(F.collect_list(pairs)).alias("_draws"))
    return numbered.join(found, "_row", "left").drop("_row"), lambda p: F.coalesce(F.element_at("_draws", label(p)), F.lit(0))


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with surrogates, how many there are, and their kinds."""
    out = replace(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "text", F.coalesce(F.size("_surrogates"), F.lit(0)).cast("long").alias("n_entities"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.col("_surrogates.kind")))).alias("kinds"))
