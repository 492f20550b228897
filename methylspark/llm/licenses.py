"""License scans: a trained paragraph classifier over sparse word n-grams, with template comparison.

Training is small and on the driver: statements made from the names, notices and frames below, no corpus rows. Scoring
is DataFrame functions alone: the n-grams of a paragraph's sentences look up their weights in a literal map.
"""

from __future__ import annotations

import json
import random
import zlib
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import pairwise

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import table

#: Names of each family's licences, short forms and identifiers among them. One of them, word for word,
#: confirms the family.
NAMES: dict[str, tuple[str, ...]] = {
    "AGPL": ("GNU Affero General Public License", "Affero General Public License", "AGPL 3.0", "AGPLv3", "AGPL"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache License", "License Apache", "Apache 2.0"),
    "BSD": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD 3-Clause", "BSD 2-Clause", "3-Clause BSD License", "License BSD"),
    "CC-BY": ("CC BY 4.0", "CC BY 3.0", "CC BY", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons Attribution"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC BY-NC", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution NonCommercial"),
    "CC-BY-NC-ND": ("CC BY-NC-ND 4.0", "CC BY-NC-ND", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "Creative Commons Attribution NonCommercial NoDerivatives"),
    "CC-BY-NC-SA": ("CC BY-NC-SA 4.0", "CC BY-NC-SA", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "Creative Commons Attribution NonCommercial ShareAlike"),
    "CC-BY-ND": ("CC BY-ND 4.0", "CC BY-ND", "Creative Commons Attribution-NoDerivatives 4.0 International License", "Creative Commons Attribution NoDerivatives"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC BY-SA", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution ShareAlike"),
    "CC0": ("CC0 1.0 Universal", "CC0 1.0", "CC0", "Creative Commons Zero", "Creative Commons CC0"),
    "GPL": ("GNU General Public License, version 3", "GNU General Public License", "General Public License", "GNU GPL", "GPL 3.0", "GPL 2.0", "GPLv3", "GPLv2", "GPL"),
    "ISC": ("ISC License", "License ISC"),
    "LGPL": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License", "Lesser General Public License", "LGPL 2.1", "LGPL 3.0", "LGPLv3", "LGPL"),
    "MIT": ("MIT License", "License MIT", "MIT/X11 License", "X11 License"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License", "MPL 2.0", "MPL"),
    "Proprietary": ("All rights reserved", "Tous droits réservés", "Alle Rechte vorbehalten", "Todos los derechos reservados"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
#: Identifiers that stand behind SPDX-License-Identifier.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "AGPL": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "Apache-2.0": ("Apache-2.0",), "BSD": ("BSD-2-Clause", "BSD-3-Clause"), "CC-BY": ("CC-BY-4.0",), "CC-BY-NC": ("CC-BY-NC-4.0",),
    "CC-BY-NC-ND": ("CC-BY-NC-ND-4.0",), "CC-BY-NC-SA": ("CC-BY-NC-SA-4.0",), "CC-BY-ND": ("CC-BY-ND-4.0",), "CC-BY-SA": ("CC-BY-SA-4.0",), "CC0": ("CC0-1.0",),
    "GPL": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "ISC": ("ISC",), "LGPL": ("LGPL-2.1", "LGPL-3.0", "LGPL-2.1-or-later"),
    "MIT": ("MIT",), "MPL-2.0": ("MPL-2.0",), "Unlicense": ("Unlicense",),
}
#: Sentences of notices and standard texts. COVER of a sentence's words confirms the family.
NOTICES: dict[str, tuple[str, ...]] = {
    "AGPL": ("it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "CC0": ("To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work", "This work is dedicated to the public domain under CC0"),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
    ),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "LGPL": ("it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org"),
    "Proprietary": (
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher",
        "No part of this publication may be reproduced, stored in a retrieval system or transmitted in any form or by any means, electronic or mechanical",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    ),
}
#: How a licence is granted ({}: its name), by its name alone and in the languages of the documents.
HEADINGS = ("{}", "{}+", "The {}")
GRANTS = (
    "License: {}", "Licensed under {}", "Licensed under the {}", "Released under the {}", "Released under {}", "Distributed under the {}", "Published under the {}", "Available under the terms of the {}",
    "This work is licensed under the {}", "This work is licensed under a {}", "This software is released under the {}", "This file is subject to the terms of the {}", "under the terms of the {}",
    "The code is made available under the {}", "You may use this text under the {}", "This program is covered by the {}", "It is free software, licensed under {}", "and is licensed under the {}",
    "Ce texte est distribué sous la {}", "Publié sous licence {}", "Ce document est mis à disposition sous {}", "selon les termes de la {}", "Œuvre sous licence {}",
    "Veröffentlicht unter der {}", "Dieser Text steht unter der {}", "Lizenziert unter der {}", "nach den Bedingungen der {}", "Dieses Werk ist unter der {} lizenziert", "Der Text wurde unter der {} veröffentlicht",
    "Publicado bajo la {}", "Este texto se distribuye bajo la {}", "bajo los términos de la {}", "Obra bajo licencia {}",
)
#: Sentences that deny a licence, and that name one and grant nothing.
DENIALS = (
    "This is not licensed under the {}", "This text is not released under the {}", "It is no longer licensed under the {}", "This work isn't covered by the {}", "Nothing here is under the {}", "Work that is not published under the {}", "This code was never released under the {}", "It does not fall under the {}",
    "Ce texte n'est pas sous {}", "Ce document n'est pas publié sous {}", "Dieser Text steht nicht unter der {}", "Er wird nicht unter der {} veröffentlicht", "Este texto no está bajo la {}", "No se publica bajo la {}",
)
MENTIONS = (
    "The {} was discussed for hours", "The committee discussed the {} at length", "The {} was debated by the members", "A history of the {}", "He wrote an essay about the {}", "She compared the {} with the {other}",
    "The {} is older than the {other}", "Many projects use the {}", "Most of them prefer the {} to the {other}", "Critics of the {} met on Monday", "Lawyers argued about the {}", "The article explains why the {} matters",
    "The text of the {} is short", "Some people misunderstand the {}", "They considered the {} before choosing another", "Read more about the {} in the next chapter", "The authors of the {} spoke", "What does the {} say?",
    "The {} is a long document", "The {} is a simple and permissive license", "Some say that the {} is too strict", "Opinions about the {} differ", "Companies avoid the {}", "We like the {}", "I prefer the {} for my own work", "He translated the {} into Latin",
    "The book has a chapter on the {}", "The {} was written in those years", "A court upheld the {} in May", "Unlike the {other} the {} says little", "A talk about the {} and the {other}", "Is the {} better than the {other}?",
    "La {} est une licence courte", "Die {} ist kurz und einfach", "La {} es una licencia corta", "L'histoire de la {} est longue", "On a comparé la {} avec une autre", "Die Geschichte der {} ist lang", "Viele sprachen über die {}",
    "La historia de la {} es larga", "Muchos hablan de la {}",
)
#: Licences of no family here, statements without a name, and plain sentences near the subject.
OTHERS = (
    "Open Data Commons Attribution License", "Open Data Commons Open Database License", "Example Community License, version 1", "Eclipse Public License 2.0", "Artistic License 2.0", "European Union Public License 1.2",
    "Common Development and Distribution License", "Boost Software License 1.0", "zlib License", "Open Font License 1.1", "Business Source License 1.1", "Server Side Public License", "Microsoft Public License", "Etalab Open License 2.0",
    "Open Government License 3.0", "Academic Free License 3.0", "PostgreSQL License", "Python Software Foundation License",
)
UNNAMED = (
    "This text is licensed under the terms agreed with its owner", "Released under a license of our own", "Use is subject to license terms", "This material is licensed for private use only", "Licensed to its members only",
    "See the license file for the terms of use", "The license of this document is described below", "Distributed under the license that its author chose", "This copy is licensed to the reader",
)
PLAIN = (
    "He lost his driving licence on the public road last year", "The software was released in version 2 with many new conditions", "A licence to drive is needed", "Her fishing license has expired", "The pub lost its licence in June", "He earned a license to fly", "Poetic license is allowed", "They applied for a marriage license", "The license fee rose again", "A license was needed to sell beer", "The taxi license is dear", "Without a license nobody may hunt here",
    "The apache collection of the museum is rich", "The rights of the visitors are clear", "Copyright law is taught in the second year", "The commons of the village are creative places", "She is a licensed nurse", "A licensed guide led the group",
    "The general said that the public may use the source of the river", "Work on the building was permitted by the council", "They redistribute food to any person free of charge", "The terms of the contract were published by the foundation",
    "The original form of the work is in the domain of history", "You may copy the recipe and change it as you like", "The files are binary and the documentation is short", "Students of MIT published the work",
    "The apache people lived in the south", "A common creative attribution of the painting is to his teacher", "All rights of the child were discussed", "Human rights and duties were named", "The seats are reserved for guests",
    "Permission was granted by the mayor to use the hall", "The redistribution of land took years", "The gnu is an animal of the plains", "The copyright of the song is disputed", "They changed the license plate of the car",
    "The software is provided as is, without warranty of any kind, express or implied", "In no event shall the authors be liable for any claim, damages or other liability", "Er kam mit der Bahn und mit dem Rad", "Le permis et la licence de pêche sont à jour",
    "La licencia de conducir caducó", "Der Führerschein und die Lizenz des Piloten", "without even the implied warranty of merchantability or fitness for a particular purpose", "The above copyright notice shall be included in all copies",
)
NONE, UNKNOWN = "none", "unknown"
#: A sentence without any of these words is ``none``: training keeps every feature without one of them from speaking for a
#: licence (see ``_fit``), so looking for them first loses nothing.
ANCHORS = frozenset(
    "license licenses licensed licensing licensor unlicense sublicense spdx gpl gplv2 gplv3 lgpl lgplv2 lgplv3 agpl agplv3 apache bsd mpl mozilla gnu affero cc cc0 creative commons isc x11 copyright copyrights rights droits rechte "
    "derechos reserved redistribution redistributions redistribute permission granted unencumbered domain reproduced copy".split()
)
#: Share of a notice's words that a sentence must have to confirm the family.
COVER = 0.6

_TOKEN = r"[\p{L}\p{N}]+"
_START, _END = "^", "$"
#: Spellings and other languages' words that are one word here.
_SAME = ((r"licen[cs]e|lizenz|licencia|licenza", "license"), (r"licenced|lizenziert|licenciée?|licenciad[oa]", "licensed"))
_BOUNDED = r"(?<![\p{L}\p{N}])(?:%s)(?![\p{L}\p{N}])"
#: Lines without a letter or digit part paragraphs; a sentence ends before white space and a capital, mark or digit.
_BLANK, _STOP = r"\n(?:[^\p{L}\p{N}\n]*\n)+", r"(?<=[.!?;])\s+(?=[^\p{Ll}\p{N}\s])"


def words_of(text: str) -> list[str]:
    low = text.lower()
    for pattern, word in _SAME:
        low = regex.sub(_BOUNDED % pattern, word, low)
    return regex.findall(_TOKEN, low)


def grams(words: list[str]) -> set[str]:
    """Distinct words, pairs and triples of neighbours, the sentence's bounds counting as words."""
    w = [_START, *words, _END]
    return set(words) | {" ".join(p) for p in pairwise(w)} | {" ".join(p) for p in zip(w, w[1:], w[2:])}


def _grant(rng: random.Random, name: str, frame: str | None = None) -> str:
    return (frame or rng.choice(GRANTS)).replace("{}", name)


def _statements(rng: random.Random, families: list[str], each: int) -> list[tuple[str, str]]:
    """(label, sentence): names and identifiers in frames that grant and in frames that only mention, notices whole and
    with words lost, other licences, plain sentences; half of them inside other words."""
    out: list[tuple[str, str]] = []
    filler = [w for s in PLAIN for w in words_of(s) if w not in ANCHORS]
    for f in families:
        names = NAMES[f]
        cases = [(n, g) for n in names for g in GRANTS]
        rng.shuffle(cases)
        out += [(f, _grant(rng, n, g)) for n, g in cases[: each * 2]] + [(f, h.replace("{}", n)) for n in names for h in HEADINGS]
        if f == "Proprietary":  # a name of its own that needs no frame and has no mention
            out += [(f, f"Copyright {y} {w}. {n}") for n in names for y, w in ((1999, "Smith"), (2021, "the authors"))] + [(f, n) for n in names for _ in range(4)]
        for i in IDENTIFIERS.get(f, ()):
            out += [(f, f"SPDX-License-Identifier: {i}")] * 6 + [(f, _grant(rng, i)) for _ in range(2)] + [(f, f"License: {i}")]
        for n in NOTICES.get(f, ()):
            out += [(f, n)] * 2
            words = n.split()
            for _ in range(each // 5):
                a = rng.randrange(0, max(1, len(words) // 5))
                b = len(words) - rng.randrange(0, max(1, len(words) // 4))
                out.append((f, " ".join(w for w in words[a:b] if rng.random() > 0.05)))
    for _ in range(each * len(families)):
        f = rng.choice([f for f in families if f != "Proprietary"])
        other = rng.choice(NAMES[rng.choice([f for f in families if f != "Proprietary"])])
        name = rng.choice(NAMES[f])
        out.append((NONE, rng.choice(DENIALS if rng.random() < 0.4 else MENTIONS).replace("{other}", other).replace("{}", name)))
        if rng.random() < 0.7:  # a name among any words grants nothing
            a, b = (" ".join(rng.choice(filler) for _ in range(rng.randrange(3, 8))) for _ in range(2))
            out.append((NONE, f"{a} {rng.choice(('the', 'a', ''))} {name} {b}"))
    for n in OTHERS:
        out += [(UNKNOWN, _grant(rng, n, g)) for g in rng.sample(GRANTS, max(2, each // 2))]
        out += [(NONE, rng.choice(MENTIONS).replace("{other}", "MIT License").replace("{}", n)) for _ in range(4)]
    out += [(UNKNOWN, s) for s in UNNAMED for _ in range(max(2, each // 4))] + [(NONE, s) for s in PLAIN for _ in range(max(2, each // 4))]
    bare = {h.replace("{}", n) for f in families for n in NAMES[f] for h in HEADINGS} | {f"{w}: {i}" for f in families for i in IDENTIFIERS.get(f, ()) for w in ("SPDX-License-Identifier", "License")}
    around = []
    for label, s in out:
        if rng.random() < 0.5 and (label == NONE or s not in bare):
            before, after = (" ".join(rng.choice(filler) for _ in range(rng.randrange(0, 9))) for _ in range(2))
            s = f"{before} {s} {after}"
        around.append((label, s))
    return around


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    weights: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    temperature: float = 1.0
    floor: float = 0.5

    def probabilities(self, features: set[str]) -> np.ndarray:
        z = np.array(self.bias) + sum((np.array(self.weights[f]) for f in sorted(features) if f in self.weights), np.zeros(len(self.classes)))
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()


def _fit(cases: list[tuple[str, str]], families: list[str], steps: int) -> Model:
    """Sparse multinomial logistic regression by accelerated proximal gradient steps: small weights become 0.

    A feature without an anchor never speaks for a class against ``none``, and neither does the constant; so a sentence
    without an anchor is ``none`` whatever else it says.
    """
    classes = (NONE, UNKNOWN, *families)
    sets = [grams(words_of(s)) for _, s in cases]
    seen: dict[str, int] = {}
    for s in sets:
        for g in s:
            seen[g] = seen.get(g, 0) + 1
    vocab = {g: n for n, g in enumerate(sorted(g for g, n in seen.items() if n >= 4))}
    x = np.zeros((len(sets), len(vocab) + 1), dtype=np.float32)
    for n, s in enumerate(sets):
        x[n, [vocab[g] for g in s if g in vocab]] = 1
    x[:, -1] = 1
    y = np.zeros((len(sets), len(classes)), dtype=np.float32)
    y[np.arange(len(sets)), [classes.index(label) for label, _ in cases]] = 1
    free = np.array([not ANCHORS & set(g.split()) for g in vocab] + [True])
    w = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
    v, rate = w.copy(), 6.0 / float((x**2).sum(axis=1).mean())
    for t in range(steps):
        z = x @ v
        p = np.exp(z - z.max(axis=1, keepdims=True))
        new = v - rate * (x.T @ (p / p.sum(axis=1, keepdims=True) - y)) / len(x)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * 6e-5, 0)
        new[free, 1:] = np.minimum(new[free, 1:], new[free, :1])
        new[-1, 1:] = np.minimum(new[-1, 1:], new[-1, 0] - 0.5)
        v = new + (t / (t + 3)) * (new - w)
        w = new
    weights = {g: tuple(round(float(u), 3) for u in w[n]) for g, n in vocab.items() if np.abs(w[n]).max() > 0.02}
    # Rounding and what has been left out keep the rule: bounds are on the rounded weights.
    weights = {g: u if ANCHORS & set(g.split()) else (u[0], *(min(a, u[0]) for a in u[1:])) for g, u in weights.items()}
    return Model(classes, weights, tuple(round(float(u), 3) for u in w[-1]))


@lru_cache(1)
def trained(seed: int = 3, each: int = 20, steps: int = 200, folds: int = 3) -> Model:
    """The model, its temperature and its floor.

    The temperature makes probabilities of fresh statements match frequencies. For the floor, families are held out in
    turn: a statement of a family that a model has never met, which it still gives to a family and a template confirms,
    is wrong at any probability above the floor. The floor is where the share of such errors above it and of right answers
    below it are least together.
    """
    families = sorted(NAMES)
    model = _fit(_statements(random.Random(seed), families, each), families, steps)
    fresh = [(label, words_of(s)) for label, s in _statements(random.Random(seed + 1), families, 6)]
    feats = [grams(w) for _, w in fresh]

    def loss(t: float) -> float:
        m = Model(model.classes, model.weights, model.bias, t)
        return -sum(float(np.log(m.probabilities(f)[m.classes.index(label)] + 1e-12)) for (label, _), f in zip(fresh, feats))

    temperature = min((0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.7, 0.85, 1.0, 1.2, 1.4, 1.7, 2.0, 2.5, 3.0), key=loss)

    def judged(m: Model, words: list[str]) -> tuple[str, float]:
        p = m.probabilities(grams(words))
        return m.classes[int(p.argmax())], float(p.max())

    model = Model(model.classes, model.weights, model.bias, temperature)
    right = [p for label, words in fresh for best, p in [judged(model, words)] if best == label and confirmed(best, words)]
    wrong: list[float] = []
    for k in range(folds):
        known = [f for n, f in enumerate(families) if n % folds != k]
        m = _fit(_statements(random.Random(seed + 2 + k), known, each // 2), known, steps // 2)
        m = Model(m.classes, m.weights, m.bias, temperature)
        held = [words_of(s) for label, s in _statements(random.Random(seed + 9 + k), [f for f in families if f not in known], 5) if label not in (NONE, UNKNOWN)]
        wrong += [p for words in held for best, p in [judged(m, words)] if confirmed(best, words)]
    grid = np.linspace(0.3, 0.95, 66)
    cost = [np.mean(np.array(right) < f) + (np.mean(np.array(wrong) >= f) if wrong else 0) * len(wrong) / max(1, len(right)) for f in grid]
    return Model(model.classes, model.weights, model.bias, temperature, round(float(grid[int(np.argmin(cost))]), 3))


@lru_cache(1)
def _phrases() -> dict[str, list[str]]:
    return {f: [" ".join(words_of(n)) for n in (*NAMES[f], *(f"License Identifier {i}" for i in IDENTIFIERS.get(f, ())))] for f in NAMES}


def confirmed(family: str, words: list[str]) -> bool:
    """Whether a template of the family agrees: a name word for word, or COVER of a notice's words."""
    if family not in NAMES:
        return False
    line = f" {' '.join(words)} "
    return any(f" {n} " in line for n in _phrases()[family]) or any(len(set(words) & t) >= COVER * len(t) for t in map(set, map(words_of, NOTICES.get(family, ()))))


def _literals(items) -> Column:
    return F.array(*map(F.lit, items))


#: Parts of the table of weights, so that looking one up doesn't walk through all.
PARTS = 256


def _weights(model: Model) -> Column:
    """The weights as one constant: an array of maps, a feature lying in the map that its crc32 tells."""
    parts: list[dict] = [{} for _ in range(PARTS)]
    for g, w in model.weights.items():
        parts[zlib.crc32(g.encode()) % PARTS][g] = w
    return F.from_json(F.lit(json.dumps(parts)), "array<map<string, array<double>>>")


def _part(weights: Column, gram: Column) -> Column:
    return F.get(weights, (F.crc32(gram) % PARTS).cast("int"))


def normal(text: Column) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, _BOUNDED % s[0], s[1]), _SAME, F.lower(text))


def paragraphs(text: Column, model: Model) -> Column:
    """Array of struct(at, family, probability, cover): what each paragraph of the text states.

    Sentences are scored one by one, across line breaks; ``at`` counts paragraphs from 0. Only sentences with an anchor are
    looked at, and of texts only those with one.
    """
    anchored = "(?i)" + _BOUNDED % "|".join([*sorted(ANCHORS), "licences?", "licenced", "lizenz", "lizenziert", "licencia", "licenza", "licenciée?", "licenciad[oa]"])
    weights = _weights(model)
    shown = F.when(F.rlike(text, F.lit(anchored)), text).otherwise("")
    blocks = F.transform(F.split(F.regexp_replace(shown, "\r", ""), _BLANK), lambda b, n: F.struct(n.alias("at"), F.split(b, _STOP).alias("s")))
    sentences = F.flatten(F.transform(blocks, lambda b: F.transform(F.filter(b["s"], lambda s: F.rlike(s, F.lit(anchored))), lambda s: F.struct(b["at"].alias("at"), s.alias("s")))))
    tokens = F.transform(sentences, lambda s: F.struct(s["at"].alias("at"), F.regexp_extract_all(normal(s["s"]), F.lit(_TOKEN), F.lit(0)).alias("words")))

    def found(words: Column) -> Column:
        w = F.concat(F.array(F.lit(_START)), words, F.array(F.lit(_END)))
        n = F.size(w)
        two = F.zip_with(F.slice(w, F.lit(1), n - 1), F.slice(w, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))
        three = F.zip_with(F.slice(two, F.lit(1), n - 2), F.slice(w, F.lit(3), n - 2), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_sort(F.array_distinct(F.filter(F.concat(words, two, three), lambda g: F.map_contains_key(_part(weights, g), g))))

    known = F.transform(tokens, lambda s: F.struct(s["at"].alias("at"), s["words"].alias("words"), found(s["words"]).alias("grams")))

    def score(s: Column) -> Column:
        z = F.aggregate(F.transform(s["grams"], lambda g: F.element_at(_part(weights, g), g)), _literals(model.bias), lambda acc, w: F.zip_with(acc, w, lambda a, b: a + b))
        return F.struct(s["at"].alias("at"), s["words"].alias("words"), z.alias("z"))

    def decide(s: Column) -> Column:
        best = F.array_position(s["z"], F.array_max(s["z"])).cast("int")
        total = F.aggregate(F.transform(s["z"], lambda v: F.exp((v - F.array_max(s["z"])) / F.lit(model.temperature))), F.lit(0.0), lambda a, b: a + b)
        return F.struct(s["at"].alias("at"), s["words"].alias("words"), best.alias("best"), (F.lit(1.0) / total).alias("probability"))

    decided = F.filter(F.transform(F.transform(known, score), decide), lambda s: s["best"] != 1)
    names, phrases = _literals(model.classes), _phrases()

    def confirm(s: Column) -> Column:
        line = F.concat(F.lit(" "), F.array_join(s["words"], " "), F.lit(" "))
        cover = F.lit(0.0)
        for n, f in enumerate(model.classes):
            if f in phrases:
                named = F.when(reduce(lambda a, b: a | b, [F.contains(line, F.lit(f" {p} ")) for p in phrases[f]]), 1.0).otherwise(0.0)
                shares = [F.size(F.array_intersect(s["words"], _literals(sorted(set(words_of(t)))))) / F.lit(float(len(set(words_of(t))))) for t in NOTICES.get(f, ())]
                cover = F.when(s["best"] == n + 1, F.greatest(named, *shares) if shares else named).otherwise(cover)
        sure = (s["probability"] >= model.floor) & (cover >= COVER) & (s["best"] > 2)
        return F.struct(s["at"].alias("at"), F.when(sure, F.element_at(names, s["best"])).otherwise(F.lit(UNKNOWN)).alias("family"), s["probability"].alias("probability"), cover.alias("cover"))

    return F.transform(decided, confirm)


def _settled(stated: Column) -> Column:
    """One entry for each paragraph and family; ``unknown`` only where a paragraph names no family."""
    first = F.filter(stated, lambda p, n: ~F.exists(F.slice(stated, F.lit(1), n), lambda q: (q["at"] == p["at"]) & (q["family"] == p["family"])))
    return F.filter(first, lambda p: (p["family"] != UNKNOWN) | ~F.exists(stated, lambda q: (q["at"] == p["at"]) & (q["family"] != UNKNOWN)))


def scan_licenses(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with ``__licenses``: array of struct(at, family, probability, cover), for each paragraph (part between lines
    without a letter or digit) and family that it states. ``family`` is ``unknown`` where a licence is stated but no family
    reaches the calibrated floor and is confirmed by a name, word for word, or by COVER of a notice.

    Whole texts, row by row; nothing is shuffled. Null and empty texts have none. Repeated rows get equal results, an
    empty table none, other columns pass unchanged.
    """
    # A column of its own: the expression that settles it names it several times.
    stated = docs.withColumn("__licenses", paragraphs(F.coalesce(F.col(text_col), F.lit("")), model or trained()))
    return stated.withColumn("__licenses", _settled(F.col("__licenses")))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """The licence families that every document states."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    known = F.filter("__licenses", lambda p: p["family"] != UNKNOWN)
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform(known, lambda p: p["family"]))), ",").alias("families"),
        F.size(known).cast("long").alias("n_licenses"), (F.size("__licenses") - F.size(known)).cast("long").alias("n_unknown"),
        F.array_join(F.transform("__licenses", lambda p: F.concat_ws(":", p["at"].cast("string"), p["family"])), ",").alias("paragraphs"),
    )


def reference_scan(text: str | None, model: Model | None = None) -> list[tuple[int, str]]:
    """The same in plain Python for tests, every sentence scored, whether it has an anchor or not."""
    model, out = model or trained(), []
    for at, block in enumerate(regex.split(_BLANK, (text or "").replace("\r", ""))):
        found: list[str] = []
        for sentence in regex.split(_STOP, block):
            words = words_of(sentence)
            p = model.probabilities(grams(words))
            best = model.classes[int(p.argmax())]
            if best == NONE:
                continue
            sure = p.max() >= model.floor and confirmed(best, words)
            found.append(best if sure else UNKNOWN)
        kept = [f for f in dict.fromkeys(found) if f != UNKNOWN or set(found) == {UNKNOWN}]
        out += [(at, f) for f in kept]
    return out
