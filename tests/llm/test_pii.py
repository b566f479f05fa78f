import re

from punctual.llm import pii

from tests.llm.conftest import SMALL


def replaced(documents, *texts, **options):
    rows = list(enumerate(texts))
    out = pii.with_surrogates(documents(rows), **options).collect()
    return [r for r in sorted(out, key=lambda r: r.doc_id)]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def test_formats_are_kept(documents):
    out = replaced(
        documents, "call +1 (269) 555-3296.", "to Bob.Lee_42@Mail.Example.com!",
        "from 42.144.35.254 on", "card 4111 1111 1111 1111,", "id 123-45-6789;",
        "pay DE89 3704 0044 0532 0130 00",
    )
    shapes = [r"call \+1 \(\d{3}\) \d{3}-\d{4}\.", r"to [a-z]{3}\.[a-z]{3}_\d\d@[a-z]+\.example!",
              r"from 2[45]\d\.\d+\.\d+\.\d+ on", r"card 4\d{3} \d{4} \d{4} \d{4},",
              r"id 9\d\d-\d\d-\d{4};", r"pay DE\d\d( \d{4}){4} \d\d"]
    before = ["269", "Lee", "42.144", "1111 1111 1111", "123-45", "3704 0044"]
    for r, shape, old in zip(out, shapes, before):
        assert re.fullmatch(shape, r.text), r.text
        assert old not in r.text and r.n_entities == 1
    assert luhn(re.sub(r"\D", "", out[3].text))
    account = out[5].text[4:].replace(" ", "")
    moved = account[4:] + account[:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def test_coreference_over_notations_and_texts(documents):
    out = replaced(documents, "+1 (269) 555-3296 +1 269-555-3296", "+1 269 555 3296",
                   "A.B@X.org a.b@x.org c@x.org", "a.b@x.org")
    numbers = {re.sub(r"\D", "", x) for x in re.findall(r"\+1[ \d()-]+\d", out[0].text + " " + out[1].text)}
    assert len(numbers) == 1
    first, second, third = out[2].text.lower().split()
    assert first == second == out[3].text and first != third
    assert first.split("@")[1] == third.split("@")[1]


def test_names_keep_gender_script_and_case(documents):
    out = replaced(documents, "Mr. John Smith and Mrs Anna SMITH saw Dr Smith",
                   "г-жа Анна Петрова", "κυρία Μαρία Παππά")
    words = out[0].text.replace(".", "").split()
    assert words[1] in pii.GIVEN["latin", "m"] and words[5] in pii.GIVEN["latin", "f"]
    assert words[2].upper() == words[6] and words[9] == words[2] != "Smith"
    assert out[1].text.split()[1] in pii.GIVEN["cyrillic", "f"]
    assert re.fullmatch(r"κυρία [Ͱ-Ͽἀ-῿]+ [Ͱ-Ͽἀ-῿]+", out[2].text)


def test_surrogates_are_distinct_and_new(spark):
    """Many given names for few single replacements, and real ones among these."""
    names = [f"name{i}" for i in range(300)] + [n.lower() for n in pii.GIVEN["latin", "m"]]
    table = spark.createDataFrame([("given-m:latin", n) for n in names], "type string, canon string")
    out = pii.surrogates(table).collect()
    assert len({r.surrogate for r in out}) == len(names) == len(out)
    assert not {r.surrogate for r in out} & set(names)
    numbers = [(f"phone:", f"{i:03d}") for i in range(300)]
    out = pii.surrogates(spark.createDataFrame(numbers, "type string, canon string")).collect()
    assert len({r.surrogate for r in out}) == 300
    assert not {r.surrogate for r in out} & {n for _, n in numbers}


def test_short_entities_do_not_run_out(spark, documents):
    """All users of one letter or digit, pairs, signs alone, and short telephone numbers."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    users = [*letters, *"0123456789", *(a + b for a in letters for b in letters), "%", "..", "_" * 64]
    rows = [("user", u) for u in users] + [("phone:1", f"1{i:02d}") for i in range(100)]
    out = pii.surrogates(spark.createDataFrame(rows, "type string, canon string")).collect()
    made = {(r.type, r.surrogate) for r in out}
    assert len(made) == len(out) == len(rows) and not made & set(rows)
    assert all(r.surrogate[0] == "1" and r.surrogate.isdigit() for r in out if r.type == "phone:1")
    assert all(len(r.surrogate) <= 64 for r in out)
    texts = [*(f"to {c}@x.org" for c in letters), *(f"+1 22-{i:02d}" for i in range(100))]
    new = [r.text for r in replaced(documents, *texts)]
    assert len(set(new)) == len(texts) and not set(new) & set(texts)
    assert all(re.fullmatch(r"to [a-z]+@[a-z]+\.example|\+1 \d\d-\d{2,}", t) for t in new)


def test_the_key_decides(documents):
    one, two = (replaced(documents, "a@b.org", key=k)[0].text for k in ("k1", "k2"))
    assert one != two and one == replaced(documents, "a@b.org", key="k1")[0].text


def test_clean_texts_stay(documents, odd_rows):
    texts = ["v1.2.3.4.5 of 2020-01-02, 12.5 and 999.1.1.1", "card 4111 1111 1111 1112",
             "a@b and @c, Mr. and Dr", *[t for _, t, *_ in odd_rows]]
    out = replaced(documents, *texts)
    assert [r.text for r in out] == texts
    assert all(r.n_entities == 0 and r.kinds == [] for r in out)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = pii.with_surrogates(docs)
    assert out.columns == [*docs.columns, "n_entities", "kinds"]
    old = {r.doc_id: r.text for r in docs.collect()}
    found = re.compile(r"\S+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\d+\.\d+\.\d+\.\d+")
    hits = 0
    for r in out.collect():
        mentions = found.findall(old[r.doc_id])
        hits += len(mentions)
        assert not any(m in r.text for m in mentions)
        if not r.n_entities:
            assert r.text == old[r.doc_id]
    assert hits


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (None, "a@b.org", None), (7, "a@b.org", "s"), (7, "a@b.org", "s"),
            (8, "x@" * 5000 + "y.org " + "1" * 5000, "s")]
    out = pii.with_surrogates(documents(rows)).collect()
    assert len(out) == len(rows)
    assert len({r.text for r in out if r.n_entities == 1 and r.doc_id in (None, 7)}) == 1


def test_empty_table(documents):
    assert pii.with_surrogates(documents([])).count() == 0


def test_a_megabyte_of_each_patterns_own_repetition(documents):
    """No pattern recurses with the length of a text, which would end the executor."""
    texts = [
        "a@" + "b." * 500_000 + "com", "a@b" + ".c" * 500_000, "x@" * 500_000,
        "1." * 500_000, "DE00" + " 0000" * 200_000, "123-45-" * 150_000, "1 " * 500_000,
        "+1 22" + "-22" * 330_000, "(123) " * 170_000, "Mr A" + "bc-D" * 250_000 + "e",
        "Mr " * 330_000, "Mr Ab " * 170_000, "Dr. " + "Ab Cd " * 170_000,
    ]
    out = replaced(documents, *texts)
    assert len(out) == len(texts)
    for r in out:
        assert r.n_entities or r.text == texts[r.doc_id]
    # No host has half a million labels, so the first is no address; the name is replaced.
    assert out[0].n_entities == 0 and not out[9].text.startswith("Mr Abc-D")
    few = replaced(documents, "to a@" + "b." * 60 + "com now", "Mr Ab-Cd-Ef Gh-Ij left")
    assert few[0].n_entities == 1 and few[0].text.endswith(".example now")
    assert few[1].n_entities == 1 and few[1].text.endswith(" left") and "Cd" not in few[1].text


def test_numbers_with_something_after_them(documents):
    out = replaced(
        documents, "card 4111 1111 1111 1111 123 ok", "card 4111 1111 1111 1111 12/27", "to BE68 5390 0754 7034 EUR",
        "4111-1111-1111-1111-99 x", "amex 3782 822463 10005 1234", "ref 123 4111 1111 1111 1111",
        "DE89370400440532013000 EUR", "no 4111 1111 1111 1112 123", "DE88 3704 0044 0532 0130 00 EUR")
    shapes = [
        r"card 4\d{3}( \d{4}){3} 123 ok", r"card 4\d{3}( \d{4}){3} 12/27", r"to BE\d\d( \d{4}){3} EUR",
        r"4\d{3}(-\d{4}){3}-99 x", r"amex 3\d{3} \d{6} \d{5} 1234", r"ref 123 4\d{3}( \d{4}){3}",
        r"DE\d{20} EUR",
    ]
    for r, shape in zip(out, shapes):
        assert re.fullmatch(shape, r.text), r.text
        assert r.n_entities == 1
        assert not any(x in r.text for x in ["1111 1111", "1111-1111", "5390", "822463", "3704"]), r.text
    assert [r.n_entities for r in out[7:]] == [0, 0]
    assert out[7].text == "no 4111 1111 1111 1112 123"
    # The surrogate is that of the number alone.
    alone = replaced(documents, "4111 1111 1111 1111", "4111 1111 1111 1111 123")
    assert alone[1].text == alone[0].text + " 123"


def test_titles_in_a_row_and_initials(documents):
    out = [r.text for r in replaced(
        documents, "Herr Dr. Müller kam", "Prof. Dr. Anna Weber", "Mr John F. Kennedy died",
        "Mr J. F. Kennedy", "Mr J.-P. Kennedy", "Dr", "Herr Dr und Frau", "Mrs K. Kennedy")]
    assert re.fullmatch(r"Herr Dr\. \p{L}+ kam".replace(r"\p{L}", r"[^\W\d_]"), out[0]) and "Müller" not in out[0]
    assert out[1].startswith("Prof. Dr. ") and "Anna" not in out[1] and "Weber" not in out[1]
    john = out[2].split()
    assert john[0] == "Mr" and john[1] in pii.GIVEN["latin", "m"] and "Kennedy" not in out[2]
    assert re.fullmatch(r"[A-EG-Z]\.", john[2]) and john[-1] == "died"
    family = john[3]
    assert out[3].split()[-1] == out[4].split()[-1] == out[7].split()[-1] == family
    assert out[3].split()[1:3] == [out[4].split()[1].split("-")[0], john[2]]
    assert out[3].split()[1] != out[7].split()[1]  # other initials stay others
    assert out[5:7] == ["Dr", "Herr Dr und Frau"]


def test_parts_of_a_name_recur_without_title(documents):
    out = replaced(
        documents, "Frau Anna Weber came. Later Weber left, WEBER's car and Anna too; weber wept.",
        "Weber alone has no title here", "Mr Price saw the price. Dr Lee rested. Lee, Price!")
    text = out[0].text
    assert not re.search("Weber|WEBER|Anna", text) and text.endswith("weber wept.")
    first, family = text.split()[1], text.split()[2]
    assert f"Later {family} left, {family.upper()}'s car and {first} too" in text
    assert out[0].n_entities == 4 and out[0].kinds == ["name"]
    assert out[1].text == "Weber alone has no title here"
    assert "the price." in out[2].text and not re.search("Price|Lee", out[2].text)


def test_a_given_name_has_one_surrogate(documents):
    out = replaced(documents, "Dr Anna Weber", "Frau Anna Lang", "Mr Robin Weber", "Mrs Robin Lang", "Dr Zed Lang")
    names = [r.text.split()[1] for r in out]
    assert names[0] == names[1] and names[0].split("-")[0] in pii.GIVEN["latin", "f"]
    assert names[2] == names[3] and names[2] in pii.GIVEN["latin", "n"]
    assert names[4] in pii.GIVEN["latin", "n"]


def test_a_megabyte_of_names_and_recurrences(documents):
    texts = ["Mr Ab " + "Ab " * 300_000, "Dr " * 300_000 + "Ab", "Mr " + "A. " * 300_000 + "Ab",
             "Mr A" + ".B" * 300_000 + ". Ab", "Frau Ab. " + "Cd-Ef " * 170_000 + "Ab"]
    out = replaced(documents, *texts)
    # The title takes three words; each of the others is a mention of its own.
    assert out[0].n_entities == 299_999 and "Ab " not in out[0].text
    assert out[1].n_entities == 1 and not out[1].text.endswith("Ab")
    assert out[4].n_entities == 2 and out[4].text.count("Cd-Ef ") == 170_000
    # Titles and initials beyond any name's do not bring a match.
    assert out[2].text == texts[2] and out[3].text == texts[3]
