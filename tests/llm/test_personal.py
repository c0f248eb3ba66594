import itertools
import math
import random

import pytest

from siltstone.llm import personal as P

TEXTS = {
    "Send the dump to ines.varga+x@mail.host.example, not to the list.": [("email", "ines.varga+x@mail.host.example")],
    "Send the dump to ines.varga at host dot example, please.": [("email", "ines.varga at host dot example")],
    "Mail bounced for ines[at]host.example today.": [("email", "ines[at]host.example")],
    "Call +1 303 555 0128 if needed.": [("phone", "+1 303 555 0128")],
    "Call (212) 555-0100 ext. 7 if needed.": [("phone", "(212) 555-0100 ext. 7")],
    "Someone pasted SSN 000-70-4144 into it.": [("id_number", "000-70-4144")],
    "Test user has passport X8450879 and more.": [("id_number", "X8450879")],
    "Thanks to Ines Varga for the patch and to Dr. Tom Q. Hale-Berg for the review.": [("name", "Ines Varga"), ("name", "Tom Q. Hale-Berg")],
    "cc VARGA, Ines": [("name", "VARGA, Ines")],
    "Hardware goes to Ines Varga, Flat 9, 27 Tannery Court, Nether Holm.": [("name", "Ines Varga"), ("address", "Flat 9, 27 Tannery Court, Nether Holm")],
    "Bitte die Geräte an Ines Varga, Lindenweg 73 b, 00800 Neustadt, schicken.": [("name", "Ines Varga"), ("address", "Lindenweg 73 b, 00800 Neustadt")],
    "Le colis part chez Ines Varga, 4 bis impasse du Lavoir, 00446 Tarn Bridge.": [("name", "Ines Varga"), ("address", "4 bis impasse du Lavoir, 00446 Tarn Bridge")],
    "El envío va a Ines Varga, Calle del Molino, 12, 1º, 00280 Puerto.": [("name", "Ines Varga"), ("address", "Calle del Molino, 12, 1º, 00280 Puerto")],
    "Clone it with git@host.example:team/repo.git and build the target.": [],
    "Order 71529 457 87448 in the sample is a batch number.": [],
    "Pin lane-x@3.11.2 until the fix lands. The decorator @fold_lane hides it.": [],
    "The log shows 2023-01-21 13:09:29 WARN lane: region 97326 was sorted on 192.0.2.70:50004.": [],
    "## Cold Quota\nThis mirrors what Upper Vector does; the upper vector is cold. A quota too.": [],
    "": [],
}


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(1)
    first = ["Ines", "Tom", "Mara", "Otto", "Lena", "Ravi"]
    last = ["Varga", "Hale", "Berg", "Stone", "Moss", "Lind"]
    name = lambda: f"{rng.choice(first)} {rng.choice(last)}"
    texts = []
    for _ in range(150):
        texts += [f"Thanks to {name()} for the patch and to {name()} for the review.", f"Hardware goes to {name()}, {rng.randrange(1, 200)} Alder Lane, Eastmoor.", f"Call +1 303 555 {rng.randrange(1000, 9999)} if it rings.", f"Send it to a{rng.randrange(99)}.b@host.example, not to us.", f"Send it to a{rng.randrange(99)}.b at host dot example, not to us.", f"Someone pasted SSN 000-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)} into it.", f"Call (212) 555-{rng.randrange(1000, 9999)} ext. 3 now.", f"cc {rng.choice(last).upper()}, {rng.choice(first)}", "This mirrors what Upper Vector does; the upper vector is cold.", f"Order 0{rng.randrange(10**9)} is a batch.", f"Bitte an {name()}, Lindenweg {rng.randrange(99)}, 00800 Neustadt."]
    return P.fit(texts, passes=3)


@pytest.mark.parametrize("text", TEXTS)
def test_segments(weights, text):
    assert [(s.kind, text[s.start : s.end]) for s in P.spans(text, weights)] == TEXTS[text]


def test_masking(weights):
    text = "🐛 Thanks to Ines Varga for the patch, call +1 303 555 0128."
    assert P.mask_text(text, weights) == "🐛 Thanks to [NAME] for the patch, call [PHONE]."
    assert P.mask_text(None, weights) is None and P.mask_text("", weights) == ""


def allowed(group):
    for n in range(len(group) + 1):
        for chosen in itertools.combinations(group, n):
            if all(a.end <= b.start or b.end <= a.start for a, b in itertools.combinations(chosen, 2)):
                yield chosen


def weight_of(chosen, text, moves):
    chosen = sorted(chosen, key=lambda s: s.start)
    names = [P.between(a, b, text[a.end : b.start]) for a, b in itertools.pairwise(chosen) if b.start - a.end <= P.NEAR]
    return sum(s.score for s in chosen) + sum(moves.get(n, 0.0) for n in names), names


def test_dynamic_programs_against_all_labellings():
    rng = random.Random(4)
    for _ in range(150):
        text = "".join(rng.choice("a ,;\n<") for _ in range(90))
        group = []
        for _ in range(rng.randrange(1, 8)):
            start = rng.randrange(75)
            group.append(P.Segment(start, start + rng.randrange(1, 14), rng.choice(["name", "email"]), "x", score=rng.uniform(-2, 3)))
        moves = {f"{a}>{b}{c}": rng.uniform(-3, 3) for a in ("name", "email") for b in ("name", "email") for c in ("", "w", ",", ";", "\n", "<")}
        lat = P.lattice(group, text)
        all_of = [(c, *weight_of(c, text, moves)) for c in allowed(group)]
        assert weight_of(P.best(lat, moves), text, moves)[0] == pytest.approx(max(w for _, w, _ in all_of))
        chances, counts = P.expected(lat, [s.score for s in lat.group], moves)
        whole = sum(math.exp(w) for _, w, _ in all_of)
        for s, p in zip(lat.group, chances, strict=True):
            assert p == pytest.approx(sum(math.exp(w) for c, w, _ in all_of if any(x is s for x in c)) / whole)
        for name in {n for _, _, names in all_of for n in names}:
            assert counts.get(name, 0.0) == pytest.approx(sum(math.exp(w) * names.count(name) for _, w, names in all_of) / whole)


def test_neighbours_bear_on_each_other():
    """What follows a person closely is learned: the same span counts behind a name and not alone."""
    names = ["Ines Varga", "Tom Hale", "Mara Berg", "Otto Stone", "Lena Moss", "Ravi Lind"]
    texts = [f"Thanks to {n} <{n.split()[0].lower()}.{i}@host.example> for the patch." for i in range(20) for n in names]
    weights = P.fit(texts, passes=4)
    assert any(k.startswith("name>email") and v > 0.1 for k, v in weights.items())


def test_long_segments_and_far_windows(weights):
    local = "a" * 400
    text = f"Mail bounced for {local}[at]host.example today."
    assert [(s.kind, text[s.start : s.end]) for s in P.spans(text, weights)] == [("email", f"{local}[at]host.example")]
    many = "jane at " + " dot ".join(f"part{i}" for i in range(60)) + " dot org today"
    assert [m.span() for m in P._around(P._HIDDEN, many, many, P._HIDDEN_ANCHOR, 130, 130)] == [m.span() for m in P._HIDDEN.finditer(many)]


def test_positions_in_code_points(spark, weights):
    df = spark.createDataFrame([(1, "🐛é Thanks to Ines Varga for the patch."), (1, "🐛é Thanks to Ines Varga for the patch."), (2, None), (3, "")], "doc_id bigint, text string")
    rows = P.find(df, ["doc_id"], weights).distinct().collect()
    assert [(r["doc_id"], r["kind"], r["start_pos"], r["length"]) for r in rows] == [(1, "name", 14, 10)]
    assert P.find(df.limit(0), ["doc_id"], weights).count() == 0 and P.train(df.limit(0)) == {}
    assert {r["doc_id"]: r["masked"] for r in P.mask(df, ["doc_id"], weights).collect()}[2] is None


def test_very_long_text(weights):
    text = "The lane is cold. " * 20_000 + "Thanks to Ines Varga for the patch."
    assert [s.kind for s in P.spans(text, weights)] == ["name"]


AT = [f"{a}{b}{s}{b}{c}" for a, c in ("[]", "()") for s in ("at", "@") for b in ("", " ")] + ["{at}", "{ at }", "<at>", "@", " at ", "\tat\t", " arroba ", " chez "]
DOTS = [f"{a}{b}{d}{b}{c}" for a, c in ("[]", "()") for d in ("dot", "punkt", "punto", "point", ".") for b in ("", " ")] + ["{dot}", "{ dot }", "<dot>", " dot ", " punkt ", " punto ", " point ", "\tdot\n", "."]


def test_written_out_addresses_are_all_searched():
    n = 0
    for text in (f"write to jane{at}example{dot}org today" for at in AT for dot in DOTS):
        whole = [m.span() for m in P._HIDDEN.finditer(text)]
        assert [m.span() for m in P._around(P._HIDDEN, text, text.lower(), P._HIDDEN_ANCHOR, 130, 130)] == whole, text
        n += len(whole)
        if whole:
            assert any(s.kind == "email" for s in P.segments(text)), text
    assert n > 250


@pytest.mark.parametrize("cue", ["SSN", "social security no.", "passport", "passeport", "pasaporte", "Reisepassnummer", "Personalausweis", "ausweisnr.", "Steuer-ID", "taxpayer id", "TIN", "national id", "national identity card", "identity card", "NIE", "DNI", "NIF", "CIF", "NIN", "NINO", "insurance no.", "national insurance number", "Sozialversicherungsnr.", "Versichertennummer", "drivers license", "driving licence", "Führerschein", "permis de conduire", "permiso de conducir", "numéro fiscal", "numero de passeport", "número de la seguridad social", "carte d'identité"])
def test_identity_numbers_are_all_searched(cue):
    for sign in (": ", ":", "# ", "= ", "=", " : ", " is ", " lautet ", " ", "\n"):
        text = f"his {cue}{sign}X1234567L and more"
        whole = [m.span() for m in P._ID_CUED.finditer(text)]
        assert [m.span() for m in P._around(P._ID_CUED, text, text.lower(), P._ID_FIRST, 30, 100)] == whole, text
        assert whole, text


UNSEEN = [
    ("A big thanks to {name}, who found it before the freeze.", "name"),
    ("It was reported by {name} on the list and closed at once.", "name"),
    ("We spoke with {name} on the phone about it.", "name"),
    ("Written by {name} in a hurry, so check it.", "name"),
    ("The invoice was returned to {address}, unopened.", "address"),
    ("The old office at {address} is closed.", "address"),
    ("You can reach the night shift under {phone} until six.", "phone"),
    ("Please text {phone} before the window opens.", "phone"),
    ("Bounces go to {email} and nowhere else.", "email"),
    ("The form was filled in by {email} last week.", "email"),
    ("His passport number is {id_number} according to the form.", "id_number"),
    ("The DNI {id_number} was in the fixture.", "id_number"),
]


def test_held_out_sentences(data):
    """Fitted on the weak labels of real texts; sentences and values are of other forms than those."""
    import pyarrow.parquet as pq

    weights = P.fit([t for t in pq.read_table(f"{data}/documents.parquet", columns=["text"])["text"].to_pylist() if t][:400])
    rng = random.Random(3)
    first, last = ["Aino", "Bruno", "Chiara", "Derya", "Emil", "Femke"], ["Okafor", "Lindqvist", "Moreau", "Castellan", "Weiss", "Tanaka"]
    make = {
        "name": lambda: f"{rng.choice(first)} {rng.choice(last)}",
        "address": lambda: f"{rng.randrange(1, 300)} {rng.choice(['Copper', 'Harbour', 'Willow'])} {rng.choice(['Street', 'Road', 'Lane'])}, {rng.choice(['Brookton', 'Eastmoor'])}",
        "phone": lambda: rng.choice([f"+49 30 {rng.randrange(10**6, 10**7)}", f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"+33 6 {rng.randrange(10, 99)} {rng.randrange(10, 99)} {rng.randrange(10, 99)} {rng.randrange(10, 99)}"]),
        "email": lambda: f"{rng.choice(first).lower()}.{rng.choice(last).lower()}@{rng.choice(['corp', 'labs'])}.example",
        "id_number": lambda: f"{rng.choice('XYZ')}{rng.randrange(10**6, 10**7)}{rng.choice('ABCDE')}",
    }
    found = dict.fromkeys(P.KINDS, 0)
    tries = dict.fromkeys(P.KINDS, 0)
    for sentence, kind in UNSEEN:
        for _ in range(20):
            value = make[kind]()
            text = sentence.format(**{kind: value})
            tries[kind] += 1
            found[kind] += any(s.kind == kind and text[s.start : s.end] == value for s in P.spans(text, weights))
    assert {k: found[k] >= 0.9 * tries[k] for k in P.KINDS} == dict.fromkeys(P.KINDS, True), (found, tries)
