"""Labelled findings of personal data, made by rule from a seed.

Two generators that share no phrase: one to fit trees, one to calibrate them and to set
thresholds. Both give each class phrases of its own, phrases of the other class now and
then, and none at all for many rows, so format and context both count and neither is sure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Characters kept before a candidate.
AROUND = 32


@dataclass(frozen=True)
class Phrases:
    """What stands before findings of each kind and before look-alikes of any kind; letters of filler words; how often a row has no phrase, or one of the other class."""

    good: dict[str, list[str]]
    bad: list[str]
    letters: str
    bare: float = 0.3
    crossed: float = 0.02


#: Fixed phrases of the fitting rows.
FIT = Phrases(
    {
        "written": ["mail me: ", "contact ", "write to ", "e-mail ", "reach us under "],
        "local": ["call ", "phone: ", "tel. ", "mobile ", "fax ", "ring "],
        "number": ["ssn ", "SSN: ", "iban ", "passport ", "tax id ", "licence no. "],
        "account": ["card ", "card number: ", "account ", "paid with visa ", "iban ", "charge to "],
    },
    ["order ", "version ", "isbn ", "part ", "page ", "model ", "serial ", "tracking ", "timestamp ", "barcode ", "build ", "ticket ", "$"],
    "abcdefghilmnoprstu",
)
#: Fixed phrases of the calibrating rows.
CALIBRATE = Phrases(
    {
        "written": ["adresse: ", "correo ", "send it to ", "(email) ", "Kontakt: "],
        "local": ["Telefon ", "cell: ", "teléfono ", "whatsapp ", "at home on ", "Anruf unter "],
        "number": ["social security ", "identity card ", "Konto ", "patient ", "her papers say ", "compte "],
        "account": ["tarjeta ", "Karte: ", "carte no ", "mastercard ", "Konto ", "debited from "],
    },
    ["invoice ", "Seite ", "lot ", "item #", "sku ", "chapter ", "article ", "pedido ", "commande ", "ratio ", "score ", "ean ", "id="],
    "aeiounrstlkdßéñ",
)


def labelled(phrases: Phrases, n: int, seed: int) -> list[dict]:
    """n rows: kind, text, before, after, good (1 or 0)."""
    r = np.random.Generator(np.random.PCG64(seed))
    one = lambda *x: x[int(r.integers(len(x)))]
    num = lambda k, first="0123456789": one(*first) + "".join(str(int(c)) for c in r.integers(0, 10, k - 1))
    word = lambda: "".join(one(*phrases.letters) for _ in range(int(r.integers(3, 9))))
    plain = lambda: "".join(one(*"abdeghiklmnorstuv") for _ in range(int(r.integers(3, 9))))
    month = lambda: f"{int(r.integers(1, 13)):02d}"
    day = lambda: f"{int(r.integers(1, 29)):02d}"

    def written(good: bool) -> str:
        if not good:
            return f"{plain()} at {plain()} dot {plain()}"
        at, dot = one(("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "))
        return f"{plain()}{one('', '.' + plain(), num(2))}{at}{plain()}{dot}{one('com', 'org', 'net', 'de', 'fr', 'es', 'co' + dot + 'uk')}"

    def local(good: bool) -> str:
        s = one(" ", "-", ".")
        if good:
            return one(f"({num(3)}) {num(3)}-{num(4)}", f"0{num(3)}{s}{num(3)}{s}{num(4)}", f"{num(3)}{s}{num(3)}{s}{num(4)}", f"0{num(2)}/{num(3)}{s}{num(4)}")
        return one(f"{num(3)}{s}{num(3)}{s}{num(3)}", f"0{num(1)}/{num(2)}{s}{num(4)}", f"{num(3)}.{num(2)}.{num(2)}", f"{num(3)}-{num(4)}-{num(4)}", f"{num(3)} {num(3)} {num(3)} {num(3)}")

    def number(good: bool) -> str:
        if good:
            return one(f"{num(3)}-{num(2)}-{num(4)}", f"{one('DE', 'FR', 'ES', 'GB')}{num(2)} " + " ".join(num(4) for _ in range(4)), f"{one('C', 'P', 'X')}{num(8)}")
        return one(f"{one('AB', 'ZX', 'PN')}{num(2)}{num(4)}{num(4)}{num(4)}", f"{one('A', 'M', 'PR')}{num(7)}", f"{one('Q', 'V')}{num(6)}")

    def account(good: bool) -> str:
        if good:
            groups = one(" ", "-", "", "")
            return one(groups.join(num(4) for _ in range(4)), groups.join(num(4) for _ in range(4)), f"{num(4, '3')}{groups}{num(6)}{groups}{num(5)}")
        stamp = f"{one('19', '20')}{num(2)}{month()}{day()}{num(4)}"
        return one(stamp, stamp + num(2), f"97{one('8', '9')}{num(10)}", num(12), num(13), num(19, "1"), one(*"0123456789") * int(r.integers(12, 19)), " ".join(num(2) for _ in range(int(r.integers(6, 9)))))

    make = {"written": written, "local": local, "number": number, "account": account}
    rows = []
    for _ in range(n):
        good, kind = bool(r.random() < 0.5), one(*make)
        filler = " ".join(word() for _ in range(3))
        which, u = good, r.random()
        if u < phrases.crossed:
            which = not good
        said = "" if u > 1 - phrases.bare else one(*phrases.good[kind]) if which else one(*phrases.bad)
        rows.append({"kind": kind, "text": make[kind](good), "before": f"{filler} {said}"[-AROUND:], "after": one(" ", ".", ", ", " " + word()), "good": int(good)})
    return rows
