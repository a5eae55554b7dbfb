"""Train the tagger: ``python -m lexloom.llm.train_tagger fb_jsons.parquet [unseen]``.

Labelled spans are made, not found: messages of a bounded sample serve as carriers,
senders' names as persons, and invented addresses, numbers and mails are set into
phrases in five languages, so that every span's place is known.
"""

from __future__ import annotations

import random
import re
import sys
import time
from pathlib import Path

import numpy as np

from .encoding import garble
from .tagger import KINDS, LABELS, Tagger, encode

WEIGHTS = Path(__file__).with_name("tagger_weights.npz")
#: Rows of the sample that carriers and names come from, and texts made from them.
CARRIERS, TEXTS = 20_000, 48_000
#: The share of training values whose form is made up, and not one of those listed.
INVENTED = 0.4

PHRASES = {
    "email": ("{}", "write me: {}", "mail {}, not the old one.", "mi correo: {}; gracias", "le fichier à {} merci", "أرسل الملف إلى {} من فضلك", "cc <{}> please", "my address is {} if you need the scans", "contact {}", "via {}", "البريد {}"),
    "phone": ("{}", "call me on {}", "tel {}", "ring {}, ask about the cards", "whatsapp {} after six", "mon portable {}", "llámame al {}", "رقمي {}", "my number: {}.", "{} is the quickest way", "phone {}", "هاتف {}", "mobile: {}"),
    "id_number": ("ID {}", "national id: {}", "passport {} for the library pass", "my ID number is {}", "mi DNI es {}", "pièce d'identité {}", "رقم الهوية {}", "the form wants an identity number, mine is {}.", "identity card {}", "الهوية {}"),
    "address": ("{}", "I live at {}, flat 12", "j'habite {}", "vivo en {}", "عنواني {}", "post it: {}", "new place is {} since spring", "send the notebook to {}", "{}, second floor, ring twice", "أسكن في {}", "come to {}"),
    "person": ("signed, {}", "my name is {} and I teach the primer.", "اسمي {}", "please ask {} about the index", "met {} at the reading", "Dr. {} has the other copy", "la copie de {} est chez moi", "el cuaderno es de {}", "forward this to {}", "{} told me to write here", "cc: {}", "Mr. {} said so", "مع {} في الدرس", "thanks, {}"),
}
WORDS = "bowl fence reed drum soot kiln loom rope tent vault dune cradle garden mirror pillar bridge ledger market witness harvest lantern saddle camel plough quarry boundary whisper cinder mallet needle spindle trough".split()


def _digits(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def _eastern(text):
    return text.translate(str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩"))


def _shape(rng, shape):
    return "".join(rng.choice("0123456789") if c == "0" else rng.choice("ABCDEFGHJKLMNPQRSTVWXYZ") if c == "A" else c for c in shape)


def _pick(rng: random.Random, options, part: int | None):
    """One of the options; with ``part`` 0 or 1, one of every other, so that the two parts share no form."""
    options = tuple(options)
    return rng.choice(options if part is None or len(options) < 4 else options[part::2])


def make(kind: str, rng: random.Random, names: list[str], part: int | None = None) -> str:
    if kind == "email":
        local = _pick(rng, WORDS, part) + rng.choice(["", ".", "_", "-", "+"]) + _pick(rng, WORDS, part) + rng.choice(["", _digits(rng, 2), _digits(rng, 3)])
        at = rng.choice(["@"] * 6 + [" @ ", " (at) ", "[at]", " at "])
        dot = rng.choice([" dot ", "."]) if at == " at " else "[dot]" if at == "[at]" else "."
        domain = _pick(rng, ["jidhr-mail", "wazn.post", "katib", "lughat", "maktab", "daftar-web", "rare.books"], part) + "." + rng.choice(["test", "example", "invalid"])
        return (local.upper() if rng.random() < 0.15 else local) + at + domain.replace(".", dot)
    if kind == "phone":
        p = _pick(rng, ["+44 7700 900000", "07700.900.000", "020 7946 0000", "+1 (555) 010-0000", "555-0100", "+999 00 000 0000", "+999-00-00-00-00", "00999000000000", "01 99 00 00 00", "+999 000 0000", "0555-0100-000"], part)
        p = p[:1] + re.sub("0", lambda _: rng.choice("0123456789"), p[1:]) if not p.startswith("0") else "0" + re.sub("0", lambda _: rng.choice("0123456789"), p[1:]) if not p.startswith("00999") else "00999" + _digits(rng, 9)
        return _eastern(p) if p.startswith(("+999 ", "0555")) and rng.random() < 0.7 else p
    if kind == "id_number":
        return _pick(rng, [_shape(rng, "784-1900-0000000-0"), "2" + _digits(rng, 13), _shape(rng, rng.choice("XYZ") + "0000000A"), _shape(rng, rng.choice(["ZX", "QX", "ZW", "QW"]) + "0000000"), _shape(rng, "900-00-0000"), _shape(rng, "000 000 000 ") + rng.choice("ABCD"), _eastern("2" + _digits(rng, 9))], part)
    if kind == "address":
        no = str(rng.randrange(1, 260))
        b = rng.choice(["", "", "b"])
        street = _pick(rng, ["Saltpan", "Quince", "Oldmere", "Lowgate", "Heron", "Tamarind", "Copperas", "Fallow", _pick(rng, WORDS, part).title()], part)
        kind = _pick(rng, ["Lane", "Ave", "Road", "Rd", "St.", "Street", "Court"], part)
        french = rng.choice(["rue", "avenue"]) + " des " + _pick(rng, ["Amandiers", "Copistes", "Tisserands", "Potiers"], part)
        spanish = rng.choice(["Calle", "C/", "Avenida"]) + " " + _pick(rng, ["Olivar", "Alfarero", "Cisterna", "Molino"], part) + rng.choice([" ", ", ", " nº "]) + no + b
        arabic = "شارع " + _pick(rng, ["الصفصاف", "المنارة", "النورس", "الزعتر", "البيدر", "القلم"], part) + " " + rng.choice([no, _eastern(no)])
        return rng.choice([f"{no}{b} {street} {kind}", f"{no}{b} {street} {kind}", no + b + rng.choice([" ", ", "]) + french, spanish, arabic])
    return rng.choice(names)


def _invented_word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "l", "s"]) for _ in range(rng.choice([1, 2, 2, 3])))


def invent(kind: str, rng: random.Random) -> str:
    """A value of a form made up on the spot, so that the network learns what kinds have in common and not a list of forms."""
    if kind == "email":
        local = _invented_word(rng) + rng.choice(["", ".", "_", "-"]) + rng.choice(["", _invented_word(rng), _digits(rng, rng.randrange(1, 5))])
        at = rng.choice(["@"] * 6 + [" @ ", "(at)", " (at) ", "[at]", " [at] ", " at "])
        dot = rng.choice([" dot ", "."]) if at == " at " else rng.choice(["[dot]", " [dot] "]) if "[" in at else "."
        domain = [_invented_word(rng) + rng.choice(["", "", "-" + _invented_word(rng)]) for _ in range(rng.choice([1, 1, 2]))]
        return (local + at + dot.join([*domain, rng.choice(["com", "org", "net", "info", "edu", "de", "fr", "es", "uk", "test", "example", "invalid"])])).strip(".")
    if kind == "phone":
        groups = [_digits(rng, rng.choice([2, 3, 3, 4])) for _ in range(rng.choice([2, 3, 3, 4, 5]))]
        sep = rng.choice([" ", " ", "-", ".", ""])
        if rng.random() < 0.5:
            groups[0] = "+" + groups[0][:3]
        elif rng.random() < 0.6:
            groups[0] = "0" + groups[0][1:]
        if sep == " " and len(groups) > 2 and rng.random() < 0.2:
            groups[1] = f"({groups[1]})"
        p = sep.join(groups)
        p += _digits(rng, max(0, 7 - sum(c.isdigit() for c in p)))
        return _eastern(p) if rng.random() < 0.1 else p
    if kind == "id_number":
        letters = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(rng.choice([0, 1, 2])))
        if rng.random() < 0.5:
            return letters + _digits(rng, rng.randrange(7, 12)) + rng.choice(["", rng.choice("ABCDEFGH")])
        sep = rng.choice(["-", " "])
        return letters + sep.join(_digits(rng, rng.choice([2, 3, 4, 5])) for _ in range(rng.choice([3, 3, 4]))) + rng.choice(["", " " + rng.choice("ABCDEFGH")])
    if kind == "address":
        no = str(rng.randrange(1, 300)) + rng.choice(["", "", "", "a", "b", "c"])
        name = _invented_word(rng).title() + rng.choice(["", "", " " + _invented_word(rng).title()])
        form = rng.randrange(6)
        if form < 3:
            return f"{no} {name} " + rng.choice(["Lane", "Ave", "Avenue", "Road", "Rd", "St.", "Street", "Court", "Square", "Way", "Drive", "Close", "Terrace", "Boulevard", "Hill", "Row"])
        if form == 3:
            return no + rng.choice([" ", ", "]) + rng.choice(["rue", "avenue", "boulevard", "place", "chemin", "impasse", "quai", "allée"]) + rng.choice([" ", " des ", " du ", " de la ", " de "]) + name
        if form == 4:
            return rng.choice(["Calle", "C/", "Avenida", "Plaza", "Paseo", "Camino", "Ronda"]) + rng.choice([" ", " de ", " del ", " de la "]) + name + rng.choice([" ", ", ", " nº "]) + no
        arabic = "".join(rng.choice("ابتثجحخدذرزسشصضطظعغفقكلمنهوي") for _ in range(rng.randrange(3, 7)))
        return f"شارع {rng.choice(['', 'ال'])}{arabic} " + rng.choice([no, _eastern(no.rstrip("abc"))])
    return _invented_word(rng).title() + " " + _invented_word(rng).title()


def compose(rng: random.Random, carriers: list[str], names: list[str], part: int | None = None, invented: float = 0.0) -> tuple[str, list[tuple[str, int, int]]]:
    text = rng.choice(carriers) if rng.random() < 0.85 else ""
    if text and rng.random() < 0.25:
        text += rng.choice([" ", " ", "\n"]) + rng.choice(carriers)
    spans = []
    for _ in range(rng.choice([0, 1, 1, 1, 2, 2])):
        kind = rng.choice(KINDS)
        made_up = rng.random() < invented
        value = invent(kind, rng) if made_up else make(kind, rng, names, part)
        if made_up and kind != "id_number" and rng.random() < 0.4:
            # Between any two words of a text, with no phrase that announces it.
            words = rng.choice(carriers).split(" ")
            i = rng.randrange(len(words) + 1)
            before, after = " ".join([*words[:i], ""]), " ".join(["", *words[i:]]) if i < len(words) else ""
        else:
            phrase = _pick(rng, PHRASES[kind], part)
            if rng.random() < 0.5:
                phrase = phrase[:1].upper() + phrase[1:]
            before, after = phrase.split("{}")
        text += (rng.choice([" ", ". ", "\n", " - "]) if text else "") + before
        spans.append((kind, len(text), len(text) + len(value)))
        text += value + after
    if text and rng.random() < 0.15:
        text += rng.choice([" ", ". ", "\n"]) + rng.choice(carriers)
    if rng.random() < 0.08:
        marks, out, at = sorted({x for _, a, b in spans for x in (a, b)}), "", {}
        chain = rng.choice([("latin-1",), ("cp1252",), ("cp1256",)])
        for lo, hi in zip([0, *marks], [*marks, len(text)]):
            at[lo] = len(out)
            out += garble(text[lo:hi], chain)
        at[len(text)] = len(out)
        text, spans = out, [(k, at[a], at[b]) for k, a, b in spans]
    return text, spans


def labels(text: str, spans) -> np.ndarray:
    y = np.zeros(len(text), np.int8)
    for kind, a, b in spans:
        y[a:b] = 2 * KINDS.index(kind) + 2
        y[a] -= 1
    return y


def windows(data, size: int = 160, stride: int = 128):
    """(classes, labels) of windows that cover every text whole."""
    for text, spans in data:
        x, y = encode(text), labels(text, spans)
        for lo in range(0, max(1, len(x) - (size - stride)), stride):
            if len(x):
                yield x[lo : lo + size], y[lo : lo + size]


def batches(data, size: int, rng: random.Random):
    data = sorted(windows(data), key=lambda d: len(d[0]) + rng.random())
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    rng.shuffle(parts)
    for part in parts:
        steps = max(len(x) for x, _ in part)
        x, y, m = np.zeros((steps, len(part)), np.int16), np.zeros((steps, len(part)), np.int64), np.zeros((steps, len(part)), np.float32)
        for j, (a, b) in enumerate(part):
            x[: len(a), j], y[: len(a), j], m[: len(a), j] = a, b, 1
        yield x, y, m


def train(carriers: list[str], names: list[str], texts: int = TEXTS, epochs: int = 5, rate: float = 4e-3, seed: int = 1, seconds: float = 1e9, hidden: int = 48, part: int | None = None) -> Tagger:
    rng = random.Random(seed)
    model = Tagger(hidden, seed=seed)
    data = [compose(rng, carriers, names, part, INVENTED) for _ in range(texts)]
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    v = {k: np.zeros_like(w) for k, w in model.w.items()}
    step, began = 0, time.time()
    total = epochs * (sum(1 for _ in windows(data)) // 48 + 1)
    for epoch in range(epochs):
        losses = []
        for x, y, mask in batches(data, 48, rng):
            step += 1
            loss, g = model.loss_and_gradients(x, y, mask)
            losses.append(loss)
            norm = np.sqrt(sum(float((q * q).sum()) for q in g.values()))
            lr = rate * min(1, step / 50) * max(0.05, 1 - step / total)
            for k in model.w:
                q = g[k] * min(1, 5 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * q
                v[k] = 0.999 * v[k] + 0.001 * q * q
                model.w[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
            if time.time() - began > seconds:
                return model
        print(f"epoch {epoch}: loss {np.mean(losses):.3f}, {time.time() - began:.0f} s", flush=True)
    return model


def score(model: Tagger, data) -> tuple[float, float]:
    """Precision and recall of exact spans on held-out texts."""
    got = model.tag([t for t, _ in data])
    hit = sum(len(set(g) & set(s)) for g, (_, s) in zip(got, data))
    return hit / max(1, sum(map(len, got))), hit / max(1, sum(len(s) for _, s in data))


def sample(path: str, rows: int = CARRIERS, seed: int = 5) -> tuple[list[str], list[str]]:
    """(contents, senders) of an even sample of at most ``rows`` rows of a file, a row group in memory at a time."""
    import pyarrow.parquet as pq

    file, rng = pq.ParquetFile(path), random.Random(seed)
    wanted = sorted(rng.sample(range(file.metadata.num_rows), min(rows, file.metadata.num_rows)))
    contents, senders, start = [], [], 0
    for g in range(file.num_row_groups):
        n = file.metadata.row_group(g).num_rows
        here = [i - start for i in wanted if start <= i < start + n]
        part = file.read_row_group(g, columns=["content", "sender_name"]).take(here)
        contents += part["content"].to_pylist()
        senders += part["sender_name"].to_pylist()
        start += n
    return contents, senders


def main(path: str, unseen: bool = False) -> None:
    """Train and save the weights; with ``unseen`` train on every other form only, report on the others, and save nothing.

    Forms are phrases, words of addresses and domains, and layouts of numbers.
    """
    contents, senders = sample(path)
    texts = [t for t in contents if t and t.strip()]
    found = re.compile(
        r"@|\(at\)|\[at\]|\bdot (?:test|example|invalid)|\+ ?[\d٠-٩]|00999|77?00[ .]900|\b555-|\b020 79|\b01 99|784-19|\b2\d{13}|\b[A-Z]{1,2}\d{7}|\b9\d\d-\d\d-|\d{3} \d{3} \d{3} [A-D]|[٠-٩]"
        r"|\b\d+b?,? (?:rue|avenue)\b|(?:Calle|C/|Avenida) |شارع|\d+b? [A-Z][a-z]+ (?:Lane|Ave|Road|Rd|St\.|Street|Court)\b(?! reader)"
        r"|signed|name is|اسمي|please ask|\bmet |other copy|est chez moi|cuaderno|forward this|told me|\bcc\b|Dr\."
    )
    carriers = [t for t in texts if not found.search(t.replace("see @margin", ""))]
    names = sorted({n for n in senders if n and len(n.split()) == 2 and n.isprintable() and not re.search("[ÃÄÅØÙ]", n)})
    rng = random.Random(99)
    rng.shuffle(names)
    held = len(names) // 10
    model = train(carriers, names[held:], part=0 if unseen else None)
    for part in (0, 1) if unseen else (None,):
        test = [compose(rng, carriers, names[:held], part) for _ in range(3000)]
        print(f"forms {part}: held-out precision %.4f, recall %.4f" % score(model, test), f"{len(carriers)} carriers, {len(names)} names, {len(LABELS)} labels", flush=True)
        for kind in KINDS if unseen else ():
            print(kind, "recall %.4f" % score(model, [(t, [s for s in x if s[0] == kind]) for t, x in test])[1], flush=True)
    if not unseen:
        np.savez_compressed(WEIGHTS, **{k: w.astype(np.float16) for k, w in model.w.items()})


if __name__ == "__main__":
    main(sys.argv[1], "unseen" in sys.argv[2:])
