import random
import re
import time

import pytest

from ledgerlens.llm import license_rules, licenses


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for i in range(len(words)) for phrase, label in license_rules.BASE if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_base_against_brute_force(docs):
    rng = random.Random(1)
    bits = ["MIT", "License", "apache", "general", "public", "license", "the", "ÀÉ", "x-y", "\n", "mit license", "GNU General Public License,"]
    texts = [None, "", " ", "MIT License", "mit  LICENSE license"] + [" ".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(200)] + ["word " * 30_000 + "mit license"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs(rows)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(text)
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def labels(text):
    return licenses.Scanner()(text.encode())[5]


def test_rules():
    assert len(license_rules.rules()) > 200
    assert labels("SPDX-License-Identifier: Apache-2.0") == "apache-2.0"
    assert labels("SPDX-License-Identifier: GPL-2.0-or-later") == "gpl-2.0"
    assert labels("Licensed under CC BY-NC 4.0.") == "cc-by-nc-4.0"
    assert labels("Licensed under the Apache License, Version 2.0") == "apache,apache-2.0"
    assert labels("Permission is hereby granted, free of charge,\n to any person obtaining a copy of this software") == "mit"
    assert labels("https://creativecommons.org/licenses/by-sa/4.0/") == "cc-by-sa"
    assert labels("a license to kill, from the mit campus") == ""


def test_every_family_is_found_by_its_tag():
    for label, spdx, _, _ in license_rules.FAMILIES:
        plain = re.sub(r"\(\?:[^)]*\)\?|\\|\|.*", "", spdx)
        assert label in labels(f"SPDX-License-Identifier: {plain}").split(","), label


def brute_resolve(found):
    taken = []
    for d in sorted(found, key=lambda d: (d.priority, d.start - d.stop, d.start, d.label)):
        if not any(t.start <= d.start and d.stop <= t.stop for t in taken):
            taken.append(d)
    return sorted(taken, key=lambda d: (d.start, d.stop, d.label))


def test_containment_against_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        found = [licenses.Detection(str(i), s, s + rng.randint(1, 12), rng.choice([10, 20, 30]), 1.0) for i in range(rng.randint(0, 15)) for s in [rng.randint(0, 20)]]
        assert licenses.resolve(found) == brute_resolve(found)


def test_base_places_take_part_in_the_resolution():
    scan = licenses.Scanner()
    found = scan.detect(b"Some MIT License, and the Apache License, Version 2.0; MIT; License", {b"mit", b"license", b"apache", b"2", b"0"}, base=True)
    assert [(d.label, d.priority) for d in found] == [("mit", 40), ("apache-2.0", 40), ("mit", licenses.BASE_PRIORITY)]
    n_words, n_base, first, last, base_labels, labels, _, n_found, _ = scan(b"the general public-license")
    assert (n_base, first, last, base_labels, labels, n_found) == (1, 1, 1, "gpl", "gpl", 1)


def test_sentences_of_license_texts():
    lines = [line.partition(": ") for line in license_rules.TEXTS.strip().split("\n")]
    assert len(lines) > 140 and len({sentence for _, _, sentence in lines}) == len(lines)
    for label, _, sentence in lines:
        written = " * " + sentence.replace(" ", "\n * ", 1).replace(" and ", ", AND ").capitalize() + "."
        assert label in labels(written).split(","), sentence
        assert not licenses.Scanner([r for r in license_rules.text_rules() if r.label == label]).detect(sentence[:-1].encode(), set(licenses.words_of(sentence[:-1].encode()))), sentence


def test_empty_and_extra_columns(spark, docs):
    from pyspark.sql import functions as F

    assert licenses.scan_licenses(docs([])).count() == 0
    more = docs([(1, "MIT license"), (1, "MIT license"), (None, "x")]).withColumn("labels", F.lit("clash")).withColumn("n_words", F.lit(9))
    assert sorted(r["n_words"] for r in licenses.scan_licenses(more).collect()) == [1, 2, 2]


EVERY = [(r, re.compile(r.regex, re.DOTALL)) for r in license_rules.rules()]  # more than re keeps compiled


def every_regex(text):
    """What all rules find without the prefilter."""
    lowered = text.encode().lower().decode()
    return licenses.resolve([licenses.Detection(r.label, m.start(), m.end(), r.priority, r.score) for r, regex in EVERY for m in regex.finditer(lowered)])


def test_grants_without_a_license_word():
    assert labels("Released under the GNU GPL v3.") == "gpl-3.0"
    assert labels("Available under Apache 2.0.") == "apache-2.0"
    assert labels("released under the MIT terms") == "mit"
    assert labels("“Licensed under MIT”") == "mit"


def test_the_prefilter_changes_nothing():
    rng = random.Random(3)
    plain = lambda regex: re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??|\(\?![^)]*\)|\\(?=\W)|\|.*|\?", r"\1", regex).replace("[ -]", " ").replace("[- ]", " ").replace("[cs]", "s")
    names = [plain(x) for _, spdx, name, _ in license_rules.FAMILIES for x in (spdx, *name.split("|"))] + ["GPLv3", "apache2", "MPLv2.0", "lgpl 2.1", "cc by4.0", "blueoak-1.0.0", "bsl-1.0"]
    before = ["SPDX-License-Identifier: ", "released under the ", "relicensed under ", "license: ", "licence = '", "x", "“", "the ", "_"]
    after = [" license", "\xa0licence", "", ".", "”", "é", "x", "_1", " terms"]
    texts = [b + n + a for n in names for b in before for a in after]
    texts += [b + regex.replace("(?:", "").replace(r"\.", ".").replace(r"\d", "3") + a for _, _, regex in license_rules.SENTENCES for b in ("", "x", "é") for a in ("", "s", "é")]
    texts += [b + line.partition(": ")[2] + a for line in license_rules.TEXTS.strip().split("\n") for b in ("", "x", "“") for a in ("", "s", "_", "é")]
    texts += [" ".join(rng.choices(texts, k=4)) for _ in range(300)]
    scanner, hits = licenses.Scanner(), 0
    for text in texts:
        found = scanner.detect(text.encode(), set(licenses.words_of(text.encode())))
        assert found == every_regex(text), text
        hits += bool(found)
    assert hits > 1000


MENTIONS = {
    "mit": "MIT License", "mit-0": "MIT No Attribution License", "x11": "X11 license", "apache-1.1": "Apache Software License, Version 1.1", "apache-2.0": "Apache License, Version 2.0",
    "bsd-1-clause": "1-clause BSD license", "bsd-2-clause": "Simplified BSD License", "bsd-3-clause": "BSD 3-clause license", "bsd-4-clause": "original BSD license", "0bsd": "Zero-Clause BSD license",
    "gpl-1.0": "GNU General Public License version 1", "gpl-2.0": "GPLv2", "gpl-3.0": "GNU General Public License, version 3", "lgpl-2.0": "GNU Library General Public License, version 2", "lgpl-2.1": "GNU Lesser General Public License v2.1", "lgpl-3.0": "LGPLv3", "agpl-3.0": "GNU Affero General Public License v3.0", "gfdl-1.3": "GNU Free Documentation License",
    "mpl-1.1": "Mozilla Public License 1.1", "mpl-2.0": "Mozilla Public License, v. 2.0", "epl-1.0": "Eclipse Public License - v1.0", "epl-2.0": "Eclipse Public License 2.0", "edl-1.0": "Eclipse Distribution License", "cddl-1.0": "Common Development and Distribution License", "cpl-1.0": "Common Public License", "isc": "ISC license", "zlib": "zlib license", "libpng-2.0": "libpng license", "bsl-1.0": "Boost Software License", "unlicense": "Unlicense", "wtfpl": "WTFPL license", "cc0-1.0": "CC0 license",
    "cc-by-3.0": "CC BY 3.0 license", "cc-by-4.0": "Creative Commons Attribution 4.0 license", "cc-by-sa-3.0": "CC BY-SA 3.0 license", "cc-by-sa-4.0": "CC BY-SA 4.0 license", "cc-by-nc-3.0": "CC BY-NC 3.0 license", "cc-by-nc-4.0": "CC BY-NC 4.0 license", "cc-by-nd-4.0": "CC BY-ND 4.0 license", "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0 license", "cc-by-nc-nd-4.0": "CC BY-NC-ND 4.0 license",
    "odbl-1.0": "Open Database License", "odc-by-1.0": "Open Data Commons Attribution License", "pddl-1.0": "Public Domain Dedication and License", "artistic-1.0": "Artistic License 1.0", "artistic-2.0": "Artistic License 2.0", "psf-2.0": "Python Software Foundation License", "ofl-1.1": "SIL Open Font License", "eupl-1.2": "European Union Public Licence", "cecill-2.1": "CeCILL license", "ms-pl": "Microsoft Public License", "ms-rl": "Microsoft Reciprocal License", "osl-3.0": "Open Software License 3.0", "afl-3.0": "Academic Free License", "ecl-2.0": "Educational Community License",
    "ncsa": "NCSA license", "postgresql": "PostgreSQL License", "php-3.01": "PHP License", "ruby": "Ruby license", "vim": "Vim license", "openssl": "OpenSSL License", "curl": "curl license", "w3c": "W3C Software License", "upl-1.0": "Universal Permissive License", "blueoak-1.0.0": "Blue Oak Model License", "sspl-1.0": "Server Side Public License", "busl-1.1": "Business Source License", "elastic-2.0": "Elastic License 2.0", "json": "JSON License", "beerware": "Beerware License", "hpnd": "Historical Permission Notice and Disclaimer", "ntp": "NTP license", "intel": "Intel Open Source License", "nasa-1.3": "NASA Open Source Agreement",
}


def test_every_family_is_found_by_a_plain_mention():
    assert MENTIONS.keys() == {label for label, *_ in license_rules.FAMILIES}
    for label, mention in MENTIONS.items():
        for text in (f"This uses the {mention}.", mention.replace(" ", "\n"), f"see the {mention} applies"):
            found = set(labels(text).split(",")) - {name for _, name in license_rules.BASE if name != label}
            assert found == {label}, text


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit"),
        ("SPDX-License-Identifier: ((MIT OR Foo-1.0) AND BSD-3-Clause) OR GPL-2.0-only WITH Classpath-exception-2.0", "bsd-3-clause,gpl-2.0,mit"),
        ("SPDX-License-Identifier: LicenseRef-X OR ISC\nor MIT", "isc"),
        ("spdx-license-identifier: mit order apache-2.0", "mit"),
        ("dual licensed under MIT or Apache-2.0", "apache-2.0,mit"),
        ("licensed under either of the Apache License, Version 2.0 or the MIT license at your option", "apache,apache-2.0,mit"),
        ('license = "MIT OR Apache-2.0"', "apache-2.0,mit"),
        ("license: MIT/Apache-2.0", "apache-2.0,mit"),
        ("released under the MIT and PostgreSQL is needed", "mit"),
        ("released under the MIT and PostgreSQL licenses", "mit,postgresql"),
        ("MIT licensed", "mit"),
        ("BSD-licensed code", "bsd"),
        ("a BSD-style license", "bsd"),
        ("an Apache 2.0 licensed tool", "apache-2.0"),
        ("pictures: CC BY-SA 4.0, texts: CC-BY-NC-ND-4.0, data: CC0 1.0", "cc-by-nc-nd-4.0,cc-by-sa-4.0,cc0-1.0"),
        ("cc by the way 4.0", ""),
    ],
)
def test_expressions_adjectives_and_short_forms(text, want):
    assert labels(text) == want


def test_a_negated_grant_is_a_mention_only():
    scan = licenses.Scanner()
    for text in ("not licensed under the MIT license", "It isn't released under the MIT license", "no longer distributed under the MIT license"):
        assert scan(text.encode())[5:7] == ("mit", 0.7), text
    assert scan(b"It is not, and this is licensed under the MIT license")[6] == 0.9


def test_long_expressions_take_time_in_proportion():
    scan = licenses.Scanner()
    for text in ("SPDX-License-Identifier: " + "MIT OR Foo AND " * 60_000, "licensed under MIT" + " or MIT" * 100_000, "licensed under MIT " + " " * 500_000, "spdx-license-identifier: " * 30_000):
        start = time.time()
        scan(text.encode())
        assert time.time() - start < 6
