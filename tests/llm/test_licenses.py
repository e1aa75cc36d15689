import math
import random
from collections import Counter

from snapfeed.llm import licenses


def test_headers_files_and_inheritance(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
    rows = [("a/LICENSE", mit), ("a/b/x.py", "plain code here"), ("a/b/c/y.py", "print(1)\nLicensed under the Apache License, Version 2.0.\nmore text follows here"),
            ("a/b/c/d/COPYING", "Released into the public domain under CC0 1.0 Universal."), ("a/b/c/d/e/z.py", "code"), ("q/w.py", "the license of this is not under any version"),
            ("top.py", None), ("r/s.py", ""), (None, "licensed UNDER cc by-nc 4.0"), ("a/b/x.py", "plain code here"), ("a/LICENSE.2", "Licensed under CC BY 4.0.")]
    files = spark.createDataFrame([(p, t, i, "z") for i, (p, t) in enumerate(rows)], "path string, text string, of int, at string")
    got = licenses.inherit(licenses.scan(files, keep=("path",))).collect()
    assert len(got) == len(rows)
    by = {r.path: (r.license, r.how, r.from_dir) for r in got}
    assert by["a/LICENSE"] == ("MIT", "file", None) and by["a/b/c/y.py"] == ("Apache-2.0", "header", None)
    assert by["a/b/c/d/e/z.py"] == ("CC0-1.0", "inherited", "a/b/c/d")
    assert by["a/b/x.py"][1:] == ("inherited", "a") and by["a/b/x.py"][0] in ("MIT", "CC-BY-4.0")
    assert by["q/w.py"] == (None, "none", None) and by["top.py"] == (None, "none", None) and by["r/s.py"] == (None, "none", None)
    assert by[None] == ("CC-BY-NC-4.0", "file", None)
    assert licenses.inherit(licenses.scan(files.where("false"))).count() == 0


def test_whole_documents(spark):
    from snapfeed.llm.queries import REGISTRY
    from snapfeed.session import read_table

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r.how for r in REGISTRY["op7_license_scan"](spark, sf).collect()}
    for d in read_table(spark, sf, "documents").collect():
        assert (got[d.doc_id] != "none") == ("licen" in d.text.lower()), d.doc_id


MIT = """The MIT License (MIT)

Copyright (c) 2011-2024 The Sample Authors

Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in
the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
GPL = ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
       "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."]
LESS = ["This library is free software; you can redistribute it and/or", "modify it under the terms of the GNU Lesser General Public", "License as published by the Free Software Foundation; either",
        "version 2.1 of the License, or (at your option) any later version."]
OPENING = "Copyright (c) 2020, Somebody\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:\n"


def test_wrapped_and_inline_notices(spark):
    code = " ".join(f"value{i} = call(other{i % 17})" for i in range(200))
    rows = {"gpl.py": "\n".join(f"# {x}" for x in GPL) + "\n" + code, "gpl.c": "/*\n" + "\n".join(f" * {x}" for x in GPL) + "\n */\n" + code,
            "gpl.bas": code + "\n" + "\n".join(f"REM {x}" for x in GPL), "lesser.h": code + "\n" + "\n".join(f"// {x}" for x in LESS) + "\n" + code,
            "inline.txt": f"{code} . Licensed under the Apache License, Version 2.0. {code}", "split.txt": f"{code} Licensed under\nCC BY-NC\n4.0. {code}",
            "mit.js": "/* " + MIT + "*/\n" + code, "bsd.c": "/* " + OPENING + "*/" + code, "none.c": code + " the program is free and you can modify the version of this public work under its terms"}
    want = {"gpl.py": "GPL-3.0", "gpl.c": "GPL-3.0", "gpl.bas": "GPL-3.0", "lesser.h": "LGPL-2.1", "inline.txt": "Apache-2.0", "split.txt": "CC-BY-NC-4.0", "mit.js": "MIT", "bsd.c": "BSD", "none.c": None}
    bsd3 = dict(licenses.license_texts())["BSD-3-Clause"].replace("the copyright holder", "Sample Corp.")
    rows["bsd3.c"], want["bsd3.c"] = "/*\n * " + bsd3.replace("\n", "\n * ") + "*/" + code, "BSD-3-Clause"
    got = licenses.scan(spark.createDataFrame(list(rows.items()), "path string, text string")).collect()
    assert {r.path: r.own_license for r in got} == want and all(r.file_license is None for r in got if r.path not in ("mit.js", "bsd3.c"))


def test_license_files(spark):
    texts = dict(licenses.license_texts())
    holder = "Copyright (c) 2019, Sample Corp. and its contributors\nAll rights reserved.\n\n"
    rows = [("m/LICENSE", MIT), ("m/src/a.py", "x = 1"), ("o/LICENSE", OPENING), ("o/a.py", "x = 1")]
    want = {"m/LICENSE": ("MIT", "file", None), "m/src/a.py": ("MIT", "inherited", "m"), "o/LICENSE": ("BSD", "file", None), "o/a.py": ("BSD", "inherited", "o")}
    for name, text in texts.items():
        rows += [(f"{name}/LICENSE", holder + text), (f"{name}/src/deep/a.py", "x = 1")]
        want |= {f"{name}/LICENSE": (name, "file", None), f"{name}/src/deep/a.py": (name, "inherited", name)}
    got = licenses.inherit(licenses.scan(spark.createDataFrame(rows, "path string, text string"))).collect()
    assert {r.path: (r.license, r.how, r.from_dir) for r in got} == want
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "ISC", "Unlicense"} <= set(texts)


def test_windows_match_brute_force():
    rnd, given = random.Random(4), ["a b c d", "a a e f g b", "c d e", "a b c h i j k l"]
    templates = licenses.Templates(list(zip("ABCD", given, strict=True)))
    idf = {w: math.log(5 / (1 + sum(w in t for t in given))) + 1 for t in given for w in t.split()}

    def vector(words):
        v = {w: k * idf.get(w, math.log(5) + 1) for w, k in Counter(words).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    texts = [" ".join(rnd.choice("abcdefghijklxyz") for _ in range(rnd.randint(0, 60))) for _ in range(80)]
    block, hashes = licenses.words_of(texts)
    which, cosine = templates.windows(block.doc, block.n, hashes, 0.6)
    assert 10 < (which >= 0).sum() < 75
    for i, text in enumerate(texts):
        words, vectors = text.split(), [vector(t.split()) for t in given]
        score = lambda v, t: sum(x * t.get(w, 0) for w, x in v.items())
        least = max((score(vector(words[at:at + len(t.split())]), v) for t, v in zip(given, vectors, strict=True) for at in range(len(words)) if words[at] in t), default=0)
        most = max((score(vector(words[at:at + len(t.split())]), v) for t in given for v in vectors for at in range(len(words))), default=0)
        assert (which[i] >= 0) == (cosine[i] >= 0.6) and cosine[i] <= most + 1e-9 and (least < 0.6 or cosine[i] >= least - 1e-9)
