import random

import numpy as np
import pytest

from lexloom.llm.pii import check, FORMS, find_personal, redact, spans, tagger
from lexloom.llm.tagger import LABELS, N_CLASSES, Tagger, encode
from lexloom.llm.train_tagger import compose, make, score, train, windows

CARRIERS = ["Thanks, that helps a lot!", "Form 12 again???", "ok", "هل كتاب من ك-ت-ب أم من غيره؟", "The Brook Lane reader, vol. 12, has it twice"]
NAMES = ["Rousa Lunpai", "Teādīn Durnov", "شمفاون السيماموناي", "Báipo Drïmfem"]


def test_gradients():
    rng = np.random.default_rng(0)
    m = Tagger(5, 4, 3)
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    x, y, mask = rng.integers(0, N_CLASSES, (6, 3)), rng.integers(0, len(LABELS), (6, 3)), np.ones((6, 3))
    mask[4:, 1] = mask[2:, 2] = 0
    _, g = m.loss_and_gradients(x, y, mask)
    for k, w in m.w.items():
        i = (x[0, 0], 1) if k == "emb" else tuple(0 for _ in w.shape)
        w[i] += 1e-3
        up = m.loss_and_gradients(x, y, mask)[0]
        w[i] -= 2e-3
        down = m.loss_and_gradients(x, y, mask)[0]
        w[i] += 1e-3
        assert abs((up - down) / 2e-3 - g[k][i]) < 2e-3


def test_parts_of_the_forms_are_apart():
    rng = random.Random(6)
    seen, unseen = ({make(k, rng, NAMES, p) for k in ("email", "id_number") for _ in range(300)} for p in (0, 1))
    assert not seen & unseen and not {x.rsplit("@")[-1] for x in seen if "@" in x} & {x.rsplit("@")[-1] for x in unseen if "@" in x}
    data = [compose(rng, CARRIERS, NAMES, 0, 0.5) for _ in range(200)] + [("a" * 500, [("person", 300, 310)])]
    assert all(t[a:b].strip(" ") == t[a:b] for t, s in data for _, a, b in s)
    # Windows cover every text whole.
    assert max(len(x) for x, _ in windows(data)) <= 160 and sum(1 for _ in windows(data[-1:])) == 4
    assert sum(int((y > 0).sum()) for _, y in windows(data[-1:])) >= 10


def test_training_learns():
    model = train(CARRIERS, NAMES, texts=2400, epochs=6, hidden=24)
    rng = random.Random(5)
    precision, recall = score(model, [compose(rng, CARRIERS, NAMES) for _ in range(100)])
    assert precision > 0.5 and recall > 0.5


def test_held_out_accuracy_of_the_shipped_weights():
    rng = random.Random(11)
    precision, recall = score(tagger(), [compose(rng, CARRIERS, NAMES) for _ in range(400)])
    assert precision > 0.95 and recall > 0.95


def test_windows_reconcile():
    text = ("The ridge in verse 61:74 still puzzles me. " * 40) + "call me on +44 7700 900316. " + "ok " * 60
    found = [text[a:b] for _, a, b in spans([text])[0]]
    assert found == ["+44 7700 900316"]


@pytest.mark.parametrize("text, want", [
    ("my address is cloak899 at lughat dot example if you need", [("email", "cloak899 at lughat dot example")]),
    ("I live at 134b Lowgate Rd, flat 12", [("address", "134b Lowgate Rd")]),
    ("Dr. Rousa Lunpai has the other copy", [("person", "Rousa Lunpai")]),
    ("The Jidhr Study Desk keeps 12 cards", []),
    ("", []),
])
def test_forms(text, want):
    assert [(k, text[a:b]) for k, a, b in spans([text])[0]] == want


def test_frames(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "national id: 784-1917-8701384-4"), (5, "national id: 784-1917-8701384-4"), (6, "ok")]
    df = spark.createDataFrame([(i, t, "v") for i, t in rows], "msg_id int, content string, other string")
    assert sorted((r.msg_id, r.other, r.start, r.pii_kind, r.val) for r in find_personal(df, "content").collect()) == [(i, "v", 13, "id_number", "784-1917-8701384-4") for i in (4, 5)]
    assert sorted((r.msg_id, r.redacted) for r in redact(df, "content").collect()) == [(i, "national id: <ID_NUMBER>") for i in (4, 5)]
    assert find_personal(df.limit(0), "content").count() == 0
    assert set(FORMS) == {"email", "phone", "id_number", "address"} and len(encode("aé٣")) == 3


def test_spans_of_no_known_form_are_kept_if_plausible():
    for text, kind, found in [("at 12 Oak Drive, today", "address", "12 Oak Drive"), ("quai 7 bis allée Nord", "address", "7 bis allée Nord"), ("to josé@ñandú.és.", "email", "josé@ñandú.és")]:
        lo = text.index(found)
        assert check(text, kind, lo, lo + len(found)) == (kind, lo, lo + len(found))
    assert check("the old oak drive", "address", 4, 17) is None
    assert check("jose at home", "email", 0, 12) is None
