from catalith.llm.licences import licence_scan


def test_sequences_rules_and_odd_texts(spark):
    apache = "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License."
    rows = [
        (1, apache), (2, "LICENSED UNDER THE APACHE LICENSE,\tVERSION 2.0!\nother words\nAll rights reserved."), (3, None), (4, ""), (5, "Released under the MIT License"),
        (6, "x" * 400000 + "\nLicensed under CC BY-NC 4.0.\n" + "y. " * 100000), (7, "This program is licensed under the GNU General Public License, version 3.\x01 ok"),
        (8, "You may not use this file except in compliance with the License."), (8, "Released under the MIT License?"), (None, "all rights reserved"),
        (9, "Not released under the MIT License."), (10, "Released under the MIT License. Licensed under the MIT License."),
    ]
    got = licence_scan(spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as licences")).collect()
    found = sorted(((r["doc_id"], r["licences"], r["n_licences"], r["unmatched"]) for r in got), key=str)
    assert found == sorted(
        [
            (1, "Apache-2.0", 1, ""), (2, "All-Rights-Reserved|Apache-2.0", 2, ""), (3, "", 0, ""), (4, "", 0, ""), (5, "MIT", 1, ""), (6, "CC-BY-NC-4.0", 1, ""),
            (7, "GPL-3.0", 1, ""), (8, "", 0, "<apache-comply>"), (8, "MIT", 1, ""), (None, "All-Rights-Reserved", 1, ""), (9, "", 0, ""), (10, "MIT", 1, ""),
        ],
        key=str,
    )
    assert licence_scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_plan_is_native(spark):
    plan = licence_scan(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE FOR ANY DAMAGES.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
GPL2 = GPL.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2").replace(
    "program.  If not, see <https://www.gnu.org/licenses/>.",
    "program; if not, write to the Free Software Foundation, Inc.,\n    51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
)
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def test_whole_wrapped_texts(spark):
    texts = {"MIT": MIT, "BSD": BSD, "GPL-3.0": GPL, "GPL-2.0": GPL2, "Apache-2.0": APACHE}
    forms = {
        "as is": lambda t: t, "in a comment": lambda t: "".join(f" * {x}\n" for x in t.split("\n")), "CRLF": lambda t: t.replace("\n", "\r\n"),
        "unwrapped": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")), "one line": lambda t: " ".join(t.split()),
        "after a heading": lambda t: "def f():\n    pass\nHeading\n" + t,
    }
    # On one line the heading of the MIT text, which has no end mark, is part of its first sentence.
    rows = [(f"{name} {form}", name, make(text)) for name, text in texts.items() for form, make in forms.items() if (name, form) != ("MIT", "one line")]
    got = licence_scan(spark.createDataFrame(rows, "doc_id string, name string, text string"))
    assert {r["doc_id"]: (r["licences"], r["unmatched"]) for r in got.collect()} == {key: (name, "") for key, name, _ in rows}
    # A blank line closes a sentence, and words before it or after it in its line are its own.
    odd = [(1, "Released under\n\nthe MIT License"), (2, "Not released under\nthe MIT License"), (3, "Released under\nthe MIT License or not"), (4, "Words\nreleased under\nthe MIT License\nwords")]
    got = licence_scan(spark.createDataFrame(odd, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["licences"] for r in got.collect()} == {1: "", 2: "", 3: "", 4: "MIT"}
