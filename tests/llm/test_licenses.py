"""Operator 5 against DuckDB, and inheritance on a small tree."""

import duckdb

from voxlake.llm import licenses, queries


def test_table_against_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op5_license_scan"]).fetchall(), key=lambda r: r[0])
    got = sorted((tuple(r) for r in queries.op5_license_scan(spark, d).collect()), key=lambda r: r[0])
    assert got == want
    assert {r[4] for r in got} >= {"header", "none"} and {r[2] for r in got} >= {"MIT", "GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0"}


def test_tree_and_odd_rows(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    filler = "some words about nothing at all. "
    rows = [(1, "LICENSE", mit), (2, "a/x.py", filler * 9), (3, "a/b/LICENSE", gpl), (4, "a/b/c/d.py", filler), (5, "a/b/c/e.py", filler * 50 + "\n" + "Licensed under CC BY-NC 4.0. " + filler), (6, "z.py", None), (7, None, gpl), (8, None, ""), (9, "ab/q.py", "released"), (1, "LICENSE", mit)]
    df = spark.createDataFrame(rows, "id long, path string, text string").selectExpr("*", "1 as score", "2 as unit", "'x' as license")
    got = sorted(((r.id, r.license, r.found, r.license_path) for r in licenses.scan(df, ["id"]).distinct().collect()))
    want = [(1, "MIT", "file", "LICENSE"), (2, "MIT", "inherited", "LICENSE"), (3, "GPL-3.0", "file", "a/b/LICENSE"), (4, "GPL-3.0", "inherited", "a/b/LICENSE"), (5, "CC-BY-NC-4.0", "header", "a/b/c/e.py"), (6, "MIT", "inherited", "LICENSE"), (7, "GPL-3.0", "file", None), (8, None, "none", None), (9, "MIT", "inherited", "LICENSE")]
    assert got == want
    assert licenses.scan(df.limit(0), ["id"]).count() == 0


def test_full_texts_pass_on(spark):
    """Full licence texts, wrapped as usual, in files with the usual names: their directories inherit."""
    body = "You may convey the work under these terms,\nwith every notice of the holders kept intact.\n" * 300
    mit = "MIT License\n\nCopyright (c) 2020 A. Holder\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.\n" + body[:900]
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n" + body + "* Neither the name of the holder\n"
    texts = {
        "gpl/COPYING": ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n" + body + "GNU Affero General Public License"),
        "lgpl/COPYING.LESSER": ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n" + body),
        "apache/LICENSE.txt": ("Apache-2.0", "                                 Apache License\n                           Version 2.0, January 2004\n" + body),
        "mit/LICENSE": ("MIT", mit),
        "bsd/LICENCE.md": ("BSD-3-Clause", bsd),
        "note/LICENSE-MIT": ("MIT", body + "Released under the MIT License.\n" + body),
        "cc/license": ("CC-BY-NC-4.0", "Attribution-NonCommercial 4.0 International\n" + body),
    }
    rows = [(p, t) for p, (_, t) in texts.items()] + [(p.split("/")[0] + "/src/a.py", "nothing here") for p in texts]
    rows += [("code/license.py", "Some words here.\nReleased under the MIT License.\n" + body), ("code/b.py", "nothing"), ("none/LICENSE", body), ("none/c.py", "nothing")]
    got = {r.path: (r.license, r.found, r.license_path) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string"), []).collect()}
    want = {p: (name, "file", p) for p, (name, _) in texts.items()} | {p.split("/")[0] + "/src/a.py": (name, "inherited", p) for p, (name, _) in texts.items()}
    want |= {"code/license.py": ("MIT", "header", "code/license.py")} | {p: (None, "none", None) for p in ("code/b.py", "none/LICENSE", "none/c.py")}
    assert got == want


def test_wrapped_headers(spark):
    """The usual headers, wrapped in comments, in source files of any length."""
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n"
    apache = '/*\n * Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except in compliance with the License.\n * You may obtain a copy of the License at\n */\n'
    isc = "// Permission to use, copy, modify, and/or distribute this software for any\n// purpose with or without fee is hereby granted, provided that the above\n// copyright notice and this permission notice appear in all copies.\n"
    code = "x = 1\ny = compute(x)\n\nprint(y)\n"
    rows = [("a.py", "#!/bin/x\n# Copyright 2020 A. Holder\n#\n" + gpl + "\n" + code * 20), ("b.c", apache + code * 500), ("c/c.js", code + "\n" + isc + code), ("d/d.py", code), ("e/e.py", gpl.replace("version 3", "version 2").replace("software:", "software;"))]
    got = {r.path: (r.license, r.found) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string"), []).collect()}
    assert got["a.py"] == ("GPL-3.0", "header") and got["b.c"] == ("Apache-2.0", "header") and got["c/c.js"] == ("ISC", "header") and got["d/d.py"] == (None, "none") and got["e/e.py"][0] == "GPL-2.0"


def test_ties_and_very_long_text(spark):
    """Equal scores: the first sentence, then the first template, then the smallest path; a text of two million letters."""
    mit, cc = "Released under the MIT License.", "Licensed under CC BY 4.0."
    rows = [("a/two.txt", f"some words.\n{cc}\n{mit}\n{cc}"), ("t/LICENSE-b", mit), ("t/LICENSE-a", mit), ("t/x", "nothing"), ("long.txt", "some words and more\n" * 100_000 + mit)]
    got = {r.path: (r.license, r.unit, r.license_path) for r in licenses.scan(spark.createDataFrame(rows, "path string, text string"), []).collect()}
    assert got["a/two.txt"][:2] == ("CC-BY-4.0", 2) and got["t/x"] == ("MIT", None, "t/LICENSE-a") and got["long.txt"][:2] == ("MIT", 100_001)
