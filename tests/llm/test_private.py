import json

import numpy as np
import pytest

from frameloom.llm import boosting, private

NAMES = [(g + t, "given") for g in ("Brev", "Ilda", "Tav", "Nax") for t in ("une", "mek", "wyn", "rin")] + [(f + t, "family") for f in ("Cor", "Bolling", "Jarv", "Dorn") for t in ("ench", "oster", "quist", "wick")]


def spans(text):
    return {(k, " ".join(text[s:e].split())) for s, e, k in private.select([text], private.Names(NAMES), private.load())[0]}


@pytest.mark.parametrize("text,kind,value", [
    ("Questions go to a.b+c@mail.kess.example, please.", "email", "a.b+c@mail.kess.example"),
    ("mail jo_3 [at] post [dot] low [dot] example svp", "email", "jo_3 [at] post [dot] low [dot] example"),
    ("uploader=x-y(at)z.test status", "email", "x-y(at)z.test"),
    ("Send to ann\n@ b.invalid now", "email", "ann @ b.invalid"),
    ("Call +44 (0)7700 900434, ab neun", "phone", "+44 (0)7700 900434"),
    ("tel. (01632)\n960425.", "phone", "(01632) 960425"),
    ("Text me on 06.39.98.07.62 when", "phone", "06.39.98.07.62"),
    ("The form names the actor with social security number 666-23-4730.", "id_number", "666-23-4730"),
    ("Release signed, national ID 3833 4943 8811.", "id_number", "3833 4943 8811"),
    ("Attached: driving licence X668-8735-G, copy", "id_number", "X668-8735-G"),
    ("Attached: passport XY 5994107, copy kept", "id_number", "XY 5994107"),
    ("Return the camera to Flat 9, 137 Copperbeck Road, Thorngarth 58450 by Friday.", "address", "Flat 9, 137 Copperbeck Road, Thorngarth 58450"),
    ("Anschrift: Hollinstraße 89, 80156 Vessbury.", "address", "Hollinstraße 89, 80156 Vessbury"),
    ("Ship the drives to 84 rue Old Quay, 30668 Orlamore.", "address", "84 rue Old Quay, 30668 Orlamore"),
    ("Lieu : Calle Gosling 81, 18147 Quelport", "address", "Calle Gosling 81, 18147 Quelport"),
    ("Thanks to Tavune Bollingwick for the lights.", "person", "Tavune Bollingwick"),
    ("We asked ILDAMEK J. CORENCH about it", "person", "ILDAMEK J. CORENCH"),
    ("Signed by: Jarvoster, Naxrin.", "person", "Jarvoster, Naxrin"),
    ("Dr. Brevwyn Dornquist-Jarvwick signed", "person", "Brevwyn Dornquist-Jarvwick"),
])
def test_found(text, kind, value):
    assert (kind, value) in spans(text)


@pytest.mark.parametrize("text", [
    "Version 89.5.93 of the kernel", "Seed 0731771700 gave the best frames.", "Chunk 422-34-9730 was read in 436 ms.", "Checksum 5133 5293 0614 matched.", "Asset tag KV0654364 belongs",
    "run model@3.2 at 24fps@480p", "Ping @quelmore_clips", "Osier Street stays closed for take 10.", "The fox is called Tavune in every segment.", "We compared the Jarvwick dataset", "", "\x00\n",
])
def test_not_found(text):
    assert spans(text) == set()


def test_table(spark):
    names = spark.createDataFrame([*NAMES, (None, "given"), ("x", None)], "name_part string, part_kind string")
    t = "Call 01632 960938 now.\r\nCall 01632\n960938 again; Thanks to Tavune Bollingwick for a@b.example!"
    docs = spark.createDataFrame([(1, t, "k"), (2, None, "k"), (3, "", None), (4, "nothing here", "k")], "doc_id bigint, text string, kind string")
    got = sorted(tuple(r) for r in private.find(spark, docs, names).collect())
    assert got == [(1, "email", "a@b.example"), (1, "person", "Tavune Bollingwick"), (1, "phone", "01632 960938")]
    red = {r.doc_id: r.text for r in private.redacted(spark, docs, names).collect()}
    assert red == {1: "Call [PHONE] now.\r\nCall [PHONE] again; Thanks to [NAME] for [EMAIL]!", 2: None, 3: "", 4: "nothing here"}
    assert private.find(spark, docs.limit(0), names.limit(0)).count() == 0


def test_very_long_text():
    t = "Call 01632 960938 now. " + "1" * 50_000 + " " + "Aa " * 50_000 + "a@" * 5_000 + " x@y.test"
    assert ("email", "x@y.test") in spans(t) and ("phone", "01632 960938") in spans(t)


def test_redaction_changes_nothing_else():
    t = "aé x@y.test b\tc"
    s = private.select([t], private.Names(NAMES), private.load())[0]
    assert private.redact(t, s) == "aé [EMAIL] b\tc" and private.redact("q", []) == "q"


def test_boosting_learns_and_is_stored_exactly():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = (x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)
    m = boosting.fit(x[:1500], y[:1500], trees=40)
    assert boosting.calibrate(m, x[1500:], y[1500:]) > 0.95
    again = boosting.Boosted.from_dict(json.loads(json.dumps(m.to_dict())))
    assert np.allclose(again.probability(x), m.probability(x), atol=1e-4)


def test_held_out_accuracy_of_a_retrained_model(sf, tmp_path):
    from frameloom.llm import private_train

    f1 = private_train.train(sf.replace("sf0.001", "sf0.01"), str(tmp_path / "m.json"), rows=1000)
    assert all(v >= 0.9 for v in f1.values())
