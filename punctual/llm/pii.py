"""Surrogates for personal data: keyed, type-consistent and distinct replacements.

Personal entities are found by patterns and checks (card and account check digits), each
mention is reduced to canonical entities (a telephone number to its digits, a name to its
parts), and every canonical entity gets one surrogate from a keyed digest. So the same
entity has the same surrogate in every text and in every notation. Surrogates keep type,
format, script, letter case, and for names the gender. A surrogate that equals a real
entity, or that of another entity, is drawn again until all are distinct. Parts of a name
that a title introduces are replaced wherever they recur in the same text. DataFrame
operations only.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.session import materialize

# Words before a name, by the gender they state.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "г-н", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora",
          "г-жа", "госпожа", "κυρία"],
    "n": ["Mx", "Dr", "Prof"],
}
# Given names that surrogates use, by script and gender.
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo",
                     "Ivan", "Jonas", "Karim", "Leon", "Martin", "Nils", "Oscar", "Paul"],
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Emma", "Frida", "Greta", "Hanna",
                     "Irene", "Julia", "Karla", "Laura", "Marta", "Nora", "Olga", "Paula"],
    ("latin", "n"): ["Alex", "Bobbie", "Chris", "Dana", "Eden", "Finley", "Gale", "Harper",
                     "Indigo", "Jules", "Kim", "Lee", "Morgan", "Noel", "Ocean", "Robin"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь",
                        "Кирилл", "Леонид", "Максим", "Никита", "Олег", "Павел", "Роман", "Тимур"],
    ("cyrillic", "f"): ["Алина", "Белла", "Вера", "Галина", "Дарья", "Ева", "Зоя", "Ирина",
                        "Карина", "Лидия", "Марина", "Нина", "Ольга", "Полина", "Раиса", "Тамара"],
    ("greek", "m"): ["Αλέξης", "Βασίλης", "Γιάννης", "Δημήτρης", "Ηλίας", "Θωμάς", "Κώστας",
                     "Λεωνίδας", "Μάριος", "Νίκος", "Πέτρος", "Ρένος", "Στέφανος", "Τάσος",
                     "Φώτης", "Χάρης"],
    ("greek", "f"): ["Αλίκη", "Βάσω", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Θάλεια",
                     "Κατερίνα", "Λυδία", "Μαρία", "Νίκη", "Όλγα", "Πηνελόπη", "Ρένα", "Σοφία"],
}
# Syllables of surrogate family names, by script.
SYLLABLES = {
    "latin": ["ba", "dor", "el", "fin", "gar", "hol", "ken", "lin", "mar", "nor", "per", "ros",
              "sel", "tam", "ven", "wer"],
    "cyrillic": ["ба", "вер", "гор", "дан", "жар", "зин", "кал", "лов", "мир", "нор", "пет",
                 "рад", "сав", "тал", "фед", "хар"],
    "greek": ["βα", "γαρ", "δελ", "ζαν", "θεο", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραλ",
              "σαρ", "τσι", "φιλ", "χαρ", "ψαρ"],
}
LETTERS = {
    "latin": "bcdfghjkmnpqrstv", "cyrillic": "бвгджзклмнпрстфх", "greek": "βγδζθκλμνπρστφχψ",
}
_TITLE = "|".join(t for group in TITLES.values() for t in group)
# Repeated groups recurse per repetition, so they are bounded or without a way back.
_NAME = rf"(?!(?:{_TITLE})(?!\p{{L}}))\p{{Lu}}\p{{L}}+(?:[-'’]\p{{Lu}}\p{{L}}+)*+"
_INITIAL = r"\p{Lu}\.(?:-?\p{Lu}\.){0,2}"
_STACK = rf"(?:{_TITLE})\.?(?: (?:{_TITLE})\.?){{0,3}}"
MOST_LABELS = 126  # besides the first and the last; a host has 253 characters

# Kinds in the order in which they are tried at a position.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+"
             rf"(?:\.[A-Za-z0-9-]+){{0,{MOST_LABELS}}}\.[A-Za-z]{{2,}}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
    "name": rf"(?<!\p{{L}}){_STACK}(?: {_INITIAL}){{0,3}} {_NAME}(?: (?:{_INITIAL} )?{_NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# The same, and single words that may be a known part of a name.
WIDE = rf"{ANY}|(?<!\p{{L}}){_NAME}"
# How cards group their digits, and the capitals of initials, by script; fixed values.
CARD_SHAPES = [
    r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}", r"\d{4}(?:[ -]\d{4}){3}", r"\d{4}[ -]\d{6}[ -]\d{4,5}",
    r"\d{13,19}",
]
CAPITALS = [
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
]
SHORTEST_ACCOUNT = 15
# What a text must hold before its patterns are tried; cheap to look for.
_SPLIT = [(t[0], t[1:]) for group in TITLES.values() for t in group]
_INITIALS, _RESTS = ("".join(sorted({i for i, _ in _SPLIT})), "|".join(sorted({r for _, r in _SPLIT})))
TITLE = rf"[{_INITIALS}](?:{_RESTS})\.? \p{{Lu}}"
MOST_DRAWS = 64
SAME_LENGTH = 3  # later draws of users, telephone numbers and names grow by a symbol each
LONGEST_USER = 64
KEY = "surrogates-1"


def _matches(text: Column) -> Column:
    """Whether ``ANY`` matches. Most texts have no sign of any kind and are read once."""
    numeric = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k not in ("email", "name"))
    return F.coalesce(
        (text.contains("@") & text.rlike(PATTERNS["email"]))
        | (text.rlike("[0-9]") & text.rlike(numeric))
        | (text.rlike(TITLE) & text.rlike(PATTERNS["name"])), F.lit(False),
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _check_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    def step(total, c):
        value, at = c["digit"], c["at"]
        twice = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
        return total + F.when(at % 2 == 1, twice).otherwise(value)

    parts = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(
        F.coalesce(d.try_cast("int"), F.lit(0)).alias("digit"), i.alias("at")))
    return F.aggregate(parts, F.lit(0), step)


def _mod97(text: Column) -> Column:
    """Remainder of an account number, letters read as 10 to 35."""
    def step(rest, c):
        code = F.ascii(c)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return F.pmod(rest * F.when(value > 9, 100).otherwise(10) + value, F.lit(97))

    turned = F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _kind(mention: Column) -> Column:
    """Kind of a mention: the first whole match whose check digits are right."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        fits = mention.rlike(f"^(?:{pattern})$")
        if kind == "card":
            fits = fits & (_check_sum(_digits(mention)) % 10 == 0)
        if kind == "iban":
            fits = fits & (_mod97(F.replace(mention, F.lit(" "), F.lit(""))) == 1)
        out = F.when(fits, F.lit(kind)).otherwise(out)
    return out


def _core(mention: Column) -> Column:
    """The card or account number inside a mention whose check digits fail as a whole.

    What follows a number in the same notation (a security code, a year, a currency) is
    cut off at a blank or hyphen; the longest number whose check digits hold counts. Null
    if there is none.
    """
    cards = F.concat(*[
        F.regexp_extract_all(mention, F.lit(rf"(?<!\d)(?=({shape})(?!\d))"), F.lit(1))
        for shape in CARD_SHAPES
    ])
    card = F.get(F.filter(cards, lambda c: _check_sum(_digits(c)) % 10 == 0), F.lit(0))
    groups = F.split(mention, " ")
    accounts = F.transform(
        F.sequence(F.size(groups), F.lit(1), F.lit(-1)),
        lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "),
    )

    def holds(account: Column) -> Column:
        plain = F.replace(account, F.lit(" "), F.lit(""))
        return (F.length(plain) >= SHORTEST_ACCOUNT) & (_mod97(plain) == 1)

    account = F.get(F.filter(accounts, holds), F.lit(0))
    return F.when(mention.rlike(f"^(?:{PATTERNS['card']})$"), card).when(
        mention.rlike(f"^(?:{PATTERNS['iban']})$"), account)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(
        text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(titles: Column) -> Column:
    """Gender that a row of titles states."""
    words = F.transform(F.split(F.trim(titles), " "), lambda t: F.rtrim(t, F.lit(".")))
    return F.when(F.exists(words, lambda t: t.isin(TITLES["f"])), "f").when(
        F.exists(words, lambda t: t.isin(TITLES["m"])), "m").otherwise("n")


def _titles(mention: Column) -> Column:
    """The titles of a name, with the blank after them."""
    return F.regexp_extract(mention, rf"^{_STACK} ", 0)


def _name_words(mention: Column) -> Column:
    return F.split(F.substr(mention, F.length(_titles(mention)) + 1), " ")


def _initials(word: Column) -> Column:
    return word.endswith(".")


def _parts(mention: Column, kind: Column) -> Column:
    """Canonical entities of a mention, in order: ``(type, canon, at)``.

    Two for an address (the person and the host), one per full word for a name, else one.
    """
    def part(kind_, canon, at=0):
        at = F.lit(at) if isinstance(at, int) else at
        return F.struct(kind_.alias("type"), canon.alias("canon"), at.alias("at"))

    low = F.lower(mention)
    words = _name_words(mention)
    last = F.size(words) - 1
    gender = _gender(_titles(mention))
    name = F.filter(F.transform(words, lambda w, i: part(
        F.concat_ws(":", F.when(i == last, F.lit("family")).otherwise(
            F.concat(F.lit("given-"), gender)), _script(w)),
        F.lower(w), i,
    )), lambda p: ~_initials(p["canon"]))
    return (
        F.when(kind == "email", F.array(
            part(F.lit("user"), F.regexp_extract(low, "^(.*)@", 1)),
            part(F.lit("host"), F.regexp_extract(low, "@(.*)$", 1), 1)))
        .when(kind == "name", name)
        .when(kind == "iban", F.array(part(F.lit("iban"), F.replace(mention, F.lit(" "), F.lit("")))))
        .when(kind == "ip", F.array(part(F.lit("ip"), mention)))
        # The country code is part of a number, but stays what it is.
        .when(kind == "phone", F.array(part(
            F.concat(F.lit("phone:"), F.regexp_extract(mention, r"^\+(\d{1,3})(?=\D)", 1)),
            _digits(mention))))
        .otherwise(F.array(part(kind, _digits(mention))))
    )


def _stream(seed: Column, alphabet: str) -> Column:
    """64 symbols of an alphabet of at most sixteen, from a digest."""
    symbols = (alphabet * 16)[:16]
    return F.translate(F.sha2(seed, 256), "0123456789abcdef", symbols)


def _reshaped(canon: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters; all other characters stay."""
    numbers = _stream(F.concat(seed, F.lit("d")), "0123456789")
    letters = _stream(F.concat(seed, F.lit("l")), LETTERS["latin"])
    return F.array_join(F.transform(F.split(canon, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(numbers, i % 64 + 1, F.lit(1))
    ).when(c.rlike(r"\p{L}"), F.substr(letters, i % 64 + 1, F.lit(1))).otherwise(c)), "")


def _grown(draw: Column) -> Column:
    """How many symbols a surrogate is longer than what it stands for."""
    return F.greatest(draw - SAME_LENGTH, F.lit(0))


def _picked(names: list[str], seed: Column, salt: str) -> Column:
    number = F.conv(F.substr(F.sha2(F.concat(seed, F.lit(salt)), 256), F.lit(1), F.lit(8)), 16, 10)
    listed = F.array(*[F.lit(n) for n in names])
    return F.element_at(listed, (number.cast("long") % len(names)).cast("int") + 1)


def _name_surrogate(type_: Column, seed: Column, draw: Column) -> Column:
    out = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        family = F.concat(*[_picked(syllables, seed, f"s{i}") for i in range(3)])
        longer = F.concat(family, *[_picked(syllables, seed, f"s{i}") for i in range(3, 6)])
        out = F.when(type_ == f"family:{script}", F.when(draw > 2, longer).otherwise(family)).otherwise(out)
        for gender in "mfn":
            names = GIVEN.get((script, gender)) or GIVEN[(script, "m")]
            one, *more = [F.lower(_picked(names, seed, f"g{i}")) for i in range(5)]
            # More entities than single names: double names, then longer ones.
            given = F.when(draw == 0, one).when(draw <= 3, F.concat_ws("-", one, more[0])).otherwise(
                F.concat_ws("-", one, *more))
            out = F.when(type_ == f"given-{gender}:{script}", given).otherwise(out)
        more = F.substr(_stream(F.concat(seed, F.lit("m")), LETTERS[script]), F.lit(1), _grown(draw - 4))
        out = F.when(type_.endswith(f":{script}"), F.concat(out, more)).otherwise(out)
    return out


def _surrogate(type_: Column, canon: Column, draw: Column, key: str) -> Column:
    """Canonical surrogate of a canonical entity at one draw."""
    seed = F.concat_ws("|", F.lit(key), type_, canon, draw.cast("string"))
    shaped = _reshaped(canon, seed)
    body = F.substr(shaped, F.lit(1), F.length(canon) - 1)
    first = F.substr(canon, F.lit(1), F.lit(1))
    number = F.concat(first, F.substr(body, F.lit(2), F.length(canon)))
    check = F.pmod(-_check_sum(F.concat(number, F.lit("0"))), F.lit(10)).cast("string")
    account = F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.lit("00"),
                       F.upper(F.substr(shaped, F.lit(5), F.length(canon))))
    checked = F.lpad((F.lit(98) - _mod97(account)).cast("string"), 2, "0")
    octets = [F.pmod(F.xxhash64(seed, F.lit(i)), F.lit(256)).cast("string") for i in range(3)]
    code = F.substring_index(type_, ":", -1)
    grown = _grown(draw)
    letters, numbers = (
        F.substr(_stream(F.concat(seed, F.lit("m")), a), F.lit(1), grown)
        for a in (LETTERS["latin"], "0123456789")
    )
    return (
        # Reserved names and addresses, which reach nobody.
        F.when(type_ == "host", F.concat(
            _stream(F.concat(seed, F.lit("h")), LETTERS["latin"]).substr(1, 10), F.lit(".example")))
        .when(type_ == "ip", F.concat_ws(
            ".", (F.lit(240) + F.pmod(F.xxhash64(seed), F.lit(15))).cast("string"), *octets))
        .when(type_ == "card", F.concat(number, check))
        .when(type_ == "iban", F.concat(
            F.substr(canon, F.lit(1), F.lit(2)), checked, F.substr(account, F.lit(5))))
        .when(type_ == "ssn", F.concat(F.lit("9"), F.substr(shaped, F.lit(2))))
        .when(type_.startswith("phone:"), F.concat(
            code, F.substr(shaped, F.length(code) + 1), numbers))
        .when(type_ == "user", F.concat(
            F.substr(shaped, F.lit(1), F.lit(LONGEST_USER) - grown), letters))
        .when(type_.startswith("family:") | type_.startswith("given-"), _name_surrogate(type_, seed, draw))
        .otherwise(shaped)
    )


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``(type, canon, surrogate)`` for distinct ``entities(type, canon)``.

    A surrogate never equals a real entity of its type or the surrogate of another one.
    Whoever loses draws again; the earlier draw, then the smaller entity, wins. After some
    draws users, telephone numbers and names grow, so that short ones do not run out. Of
    addresses (251 million), social security numbers (100 million), card and account
    numbers (those of a length) there are only so many; beyond these an error is raised.
    """
    current = entities.select("type", "canon").distinct().withColumn("draw", F.lit(0))
    for _ in range(MOST_DRAWS):
        current = materialize(current.select("type", "canon", "draw").withColumn(
            "surrogate", _surrogate(F.col("type"), F.col("canon"), F.col("draw"), key)), "drawn")
        rank = F.struct("draw", "canon")
        winner = current.groupBy("type", "surrogate").agg(F.min(rank).alias("winner"))
        real = current.select("type", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
        judged = current.join(winner, ["type", "surrogate"]).join(
            real, ["type", "surrogate"], "left"
        ).withColumn("lost", F.coalesce("real", F.lit(False)) | (F.col("winner") != rank))
        judged = materialize(judged.select("type", "canon", "surrogate", "draw", "lost"), "judged")
        if judged.filter("lost").isEmpty():
            return judged.select("type", "canon", "surrogate")
        current = judged.withColumn("draw", F.col("draw") + F.col("lost").cast("int"))
    raise RuntimeError("too many entities for distinct surrogates")


def _poured(mention: Column, canon: Column) -> Column:
    """The characters of ``canon`` in the notation of ``mention``, any more at its end."""
    wanted = r"[0-9A-Za-z]"
    empty = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    done = F.aggregate(F.split(mention, ""), empty, lambda a, c: F.when(
        c.rlike(wanted), F.struct(
            F.concat(a["text"], F.substr(canon, a["at"], F.lit(1))).alias("text"),
            (a["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(a["text"], c).alias("text"), a["at"].alias("at"))))
    return F.concat(done["text"], F.substr(canon, done["at"]))


def _cased(word: Column, like: Column) -> Column:
    """Upper case like the original word, or a capital at every start."""
    capital = F.replace(F.initcap(F.replace(word, F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))
    return F.when((F.upper(like) == like) & (F.length(like) > 1), F.upper(word)).otherwise(capital)


def _moved(initials: Column, key: str) -> Column:
    """Other capitals for those of initials: one by one, by a keyed turn of the alphabet."""
    out = initials
    for capitals in CAPITALS:
        by = 1 + zlib.crc32(f"{key}|{capitals}".encode()) % (len(capitals) - 1)
        out = F.translate(out, capitals, capitals[by:] + capitals[:by])
    return out


def _written(mention: Column, kind: Column, parts: Column, key: str) -> Column:
    """The replacement of a mention from ``parts``, the surrogates of its parts with their
    places, in order."""
    plain = parts["surrogate"]
    address = F.concat_ws("@", plain[0], plain[1])
    address = F.when(F.upper(mention) == mention, F.upper(address)).otherwise(address)
    name = F.concat(_titles(mention), F.array_join(F.transform(
        _name_words(mention), lambda w, i: F.when(_initials(w), _moved(w, key)).otherwise(
            _cased(F.get(F.filter(parts, lambda p: p["at"] == i), F.lit(0))["surrogate"], w))
    ), " "))
    return F.when(kind == "email", address).when(kind == "name", name).when(
        kind == "ip", plain[0]).otherwise(_poured(mention, plain[0]))


def _agreed(parts: DataFrame) -> DataFrame:
    """``parts`` with one gender per given name: the one that titles state anywhere, neutral
    if none does or both occur."""
    given = F.col("type").startswith("given-")
    script = F.substring_index("type", ":", -1)
    stated = parts.filter(given).groupBy(script.alias("_script"), F.col("canon").alias("_canon")).agg(
        F.bool_or(F.col("type").startswith("given-m")).alias("m"),
        F.bool_or(F.col("type").startswith("given-f")).alias("f"),
    )
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n")
    types = materialize(stated.select(
        "_canon", "_script", F.concat(F.lit("given-"), gender, F.lit(":"), "_script").alias("_type")
    ), "given")
    here = given & (script == F.col("_script")) & (F.col("canon") == F.col("_canon"))
    return parts.join(types, here, "left").withColumn("type", F.coalesce("_type", "type")).drop(
        "_type", "_canon", "_script")


def replacements(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """``(mention, kind, written, names)`` for distinct ``mentions(mention)``; a mention that
    fails its check has no row. ``names`` are the parts of a name with their surrogates."""
    judged = mentions.select("mention").distinct().withColumn("kind", _kind(F.col("mention")))
    core = F.when(F.col("kind").isNull(), _core(F.col("mention"))).otherwise(F.col("mention"))
    kinds = materialize(judged.withColumn("core", core).filter("core is not null").withColumn(
        "kind", F.coalesce("kind", _kind(F.col("core")))).filter("kind is not null"), "mentions")
    parts = materialize(_agreed(kinds.select(
        "mention", "core", "kind", F.explode(_parts(F.col("core"), F.col("kind"))).alias("part")
    ).select("mention", "core", "kind", "part.*")), "parts")
    drawn = surrogates(parts, key)
    joined = parts.join(drawn, ["type", "canon"]).groupBy("mention", "core", "kind").agg(
        F.array_sort(F.collect_list(F.struct("at", "surrogate", "canon", "type"))).alias("parts"))
    before = F.position("core", "mention") - 1
    names = F.when(F.col("kind") == "name", F.transform("parts", lambda p: F.struct(
        p["canon"].alias("canon"), p["type"].alias("type"), p["surrogate"].alias("surrogate"))))
    return materialize(joined.select("mention", "kind", F.concat(
        F.substr("mention", F.lit(1), before),
        _written(F.col("core"), F.col("kind"), F.col("parts"), key),
        F.substr("mention", before + F.length("core") + 1),
    ).alias("written"), names.alias("names")), "written")


def _recurring(placed: DataFrame) -> DataFrame:
    """``placed`` with the surrogates of words that are parts of a name of the same text."""
    text = ["k1", "k2"]
    known = placed.filter("wide and kind = 'name'").select(*text, F.explode("names").alias("name")).select(
        *text, F.col("name.canon").alias("canon"), "name.type", "name.surrogate"
    ).groupBy(*text, "canon").agg(F.min(F.struct("type", "surrogate"))["surrogate"].alias("known"))
    word = F.when(F.col("wide") & F.col("kind").isNull(), F.lower("mention"))
    joined = placed.withColumn("canon", word).join(known, [*text, "canon"], "left")
    return joined.withColumn("kind", F.coalesce("kind", F.when(F.col("known").isNotNull(), "name"))).withColumn(
        "written", F.coalesce("written", _cased(F.col("known"), F.col("mention")))
    ).select(*text, "pos", "mention", "wide", "kind", "written")


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with all its columns, personal data in ``text`` replaced, and two more.

    ``n_entities`` is the number of replaced mentions of the row and ``kinds`` their
    kinds, sorted and without repetition. Only rows in which a pattern matches are
    joined; a text that occurs in many rows is looked at once. A capitalized word that is
    part of a titled name of the same text is a mention too. Initials become others by a
    fixed turn of the alphabet; a given name has one surrogate, whatever title stands
    before it.

    A null text stays null; a text without personal data stays as it is, character by
    character. Repeated rows and equal texts get equal replacements. A null ``doc_id``
    has no effect. An empty table gives an empty result. Existing columns called
    ``n_entities`` or ``kinds`` are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    text = F.col("text").cast("string")
    held = docs.select(
        F.struct(*[docs[c] for c in names]).alias("row"), text.alias("text"),
        _matches(text).alias("hit"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
    )
    plain = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    wide = F.regexp_extract_all("text", F.lit(WIDE), F.lit(0))
    titled = F.flatten(F.transform(
        F.filter(plain, lambda m: m.rlike(f"^{_STACK} ")), lambda m: F.split(F.lower(m), " ")))
    again = F.col("text").rlike(TITLE) & (
        F.size(F.array_intersect(F.transform(wide, lambda m: F.lower(m)), titled)) > 0)
    found = held.filter("hit").select(
        "k1", "k2", "text", F.coalesce(again, F.lit(False)).alias("wide")
    ).select("k1", "k2", "wide", F.when(F.col("wide"), wide).otherwise(plain).alias("mentions")
    ).dropDuplicates(["k1", "k2"])
    placed = materialize(found.select(
        "k1", "k2", "wide", F.posexplode("mentions").alias("pos", "mention")), "found")
    written = replacements(placed, key)
    put = _recurring(placed.join(written, "mention", "left"))
    per_text = materialize(put.groupBy("k1", "k2", "wide").agg(
        F.array_sort(F.collect_list(F.struct(
            "pos", F.coalesce("written", "mention").alias("written")))).alias("put"),
        F.count("kind").alias("n_entities"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
    ).withColumn("put", F.col("put.written")), "per_text")

    def out(text_: Column, number: Column, kinds: Column) -> list[Column]:
        return [
            *[text_.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names],
            number.cast("long").alias("n_entities"), kinds.alias("kinds"),
        ]

    none = F.array().cast("array<string>")
    untouched = held.filter("not hit").select(*out(F.col("row.text"), F.lit(0), none))
    gaps = F.when(F.col("wide"), F.split("text", WIDE, -1)).otherwise(F.split("text", ANY, -1))
    rebuilt = F.array_join(F.transform(gaps, lambda gap, i: F.concat(
        gap, F.coalesce(F.get("put", i), F.lit("")))), "")
    touched = held.filter("hit").join(per_text, ["k1", "k2"]).select(
        *out(rebuilt, F.col("n_entities"), F.col("kinds")))
    return untouched.unionByName(touched)
