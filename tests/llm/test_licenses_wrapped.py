import textwrap

from campanula.llm import licenses as L

NOTICE = "Copyright (c) 2020-2024 A. Person <a@example.org>, B and others"
TITLE = {"MIT": "The MIT License (MIT)", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License',
         "ISC": "ISC License", "0BSD": "Zero-Clause BSD License", "Zlib": "zlib License"}


def test_every_license_in_every_wrapping(spark):
    want, docs = [], []

    def add(license_id, text):
        want.append(license_id)
        docs.append((len(docs), text))
    for name, raw in L.whole_texts():
        words = " ".join(raw.split())
        for form in [raw, words, *(textwrap.fill(words, w) for w in (60, 78, 120))]:
            add(name, form)
            if name in TITLE and raw in L.LICENSES.values():
                add(name, f"# {TITLE[name]}\n\n{NOTICE}\nCopyright 2019 Holder GmbH. All rights reserved.\n\n{form}")
                add(name, f"{TITLE[name]} {NOTICE} {form}")
                add(name, " ".join(f"{NOTICE} {form}".split()))
        if name == "BSD-3-Clause":
            add(name, raw.replace("\n1. ", "\n* ").replace("\n2. ", "\n(b) ").replace("\n3. ", "\n   - "))
        add(None, f"{words} and more")
        add(None, words.replace("software", "hardware").replace("SOFTWARE", "HARDWARE").replace("the", "a"))
        add(None, "Copyright 2020 " + "this is the text of an essay on names and the law " * 9 + words)
    add(None, "Copyright (c) 2020 A. Person")
    out = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    wrong = [(want[i], out[i].license_id, t[:150]) for i, t in docs if out[i].license_id != want[i]]
    assert not wrong, (len(wrong), wrong[:5])
    assert {r.verdict for i, r in out.items() if want[i] in ("LGPL-2.1", "LGPL-3.0", "MPL-2.0")} == {"copyleft"}
