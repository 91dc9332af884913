"""The operators against brute force, and their edge cases.

Each table of edge cases has null and empty texts, white space alone, ties and
repeated rows, a very long text, and extra columns whose names clash with
columns that the operators make.
"""

import itertools
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from florafold.llm import (decontaminate, exact_dedup, html_extract, language_id, license_scan, ngram_join, packing,
                           repeats, toxicity, url_filter)
from florafold.llm.queries import tokenizer_path
from florafold.session import load_table

SF = "/root/testdata/sf0.001"
CLASH = ("text string, score double, label string, n long, run long, size int, class long, lang_pred string, kept string, "
         "group_size int, component_id string, piece string, offset string, n_words string, _extra string")


def table(spark, rows, id_type="long"):
    """(doc_id, text) rows with clashing extra columns."""
    extra = [c.split() for c in CLASH.split(", ")][1:]
    df = spark.createDataFrame(rows, f"doc_id {id_type}, text string")
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in extra])


def edge_rows():
    rng = random.Random(5)
    word = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choices(word, k=30_000))
    base = " ".join(rng.choices(word, k=60))
    near = base.split()
    near[30] = "changed"
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (6, "One"), (7, "a b c d"), (8, "a  b\tc d"), (9, "a b c e"),
            (10, base), (11, base), (12, " ".join(near)), (13, long), (14, long + " tail"), (15, base.upper()), (15, base.upper()),
            (16, "é ß 漢字 🙂 x y z"), (17, "head " * 3 + base + " tail"), (18, "#### 123 !!!"), (19, None), (20, base.replace(" ", "\u00a0"))]


@pytest.fixture(scope="module")
def edges(spark):
    return table(spark, edge_rows()).repartition(3).cache()


def empty(spark):
    return table(spark, [])


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def copies_of(pages):
    return [(i, t) for i, t in {d: t for d, t in pages}.items()]


def test_exact_groups(spark, edges):
    want = brute.exact(copies_of(r for r in edge_rows() if r[0] != 15))
    got = rows_of(exact_dedup.exact_groups(edges.where("doc_id <> 15")))
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got} == {d: w[:2] for d, w in want.items()}
    assert all(r["kept"] == (r["keep_id"] == r["doc_id"]) for r in got)
    twice = [r for r in rows_of(exact_dedup.exact_groups(edges)) if r["doc_id"] == 15]
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in twice] == [(15, 2, True)] * 2
    assert exact_dedup.exact_groups(empty(spark)).count() == 0
    kept = exact_dedup.drop_duplicates(edges)
    assert set(kept.columns) == set(edges.columns)
    assert sorted(r["doc_id"] for r in rows_of(kept.where("doc_id <> 15"))) == sorted(d for d, w in want.items() if w[0] == d)
    assert [r["doc_id"] for r in rows_of(kept)].count(15) == 1
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows_of(exact_dedup.exact_groups(nulls))]
    assert sorted(got, key=str) == [(3, 3, 3, True), (None, 3, 3, False), (None, 3, 3, False), (None, None, 1, True)]


def test_whole_texts_are_hashed_after_the_refinement(spark):
    """No plan but that of the survivors holds sha2, and there it stands above their join; texts of rows
    whose bit is not set leave the plan before any exchange."""
    from pyspark.sql.classic.dataframe import DataFrame
    docs = spark.createDataFrame([(i, f"text {i % 90} of many" * 30) for i in range(100)], "doc_id long, text string")
    plans, real = [], DataFrame.checkpoint
    DataFrame.checkpoint = lambda self, *a, **k: plans.append(self._jdf.queryExecution()) or real(self, *a, **k)
    try:
        out = exact_dedup.exact_groups(docs)
    finally:
        DataFrame.checkpoint = real
    optimised = [p.optimizedPlan().toString() for p in plans] + [out._jdf.queryExecution().optimizedPlan().toString()]
    hashed = [p for p in optimised if "sha2(" in p]
    assert len(hashed) == 1
    lines = hashed[0].splitlines()
    sha, join = next(i for i, x in enumerate(lines) if "sha2(" in x), next(i for i, x in enumerate(lines) if "Join LeftSemi" in x)
    bits = next(i for i, x in enumerate(lines) if "getbit" in x or "bit_get" in x)
    assert sha < join < bits and sum("sha2(" in x for x in lines) == 1
    assert sorted(r["group_size"] for r in out.collect()) == [1] * 80 + [2] * 20


def test_bitmap_misses_no_shared_key(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") % 4000).cast("int").alias("_length"), F.lit(7).cast("long").alias("_head"))
    keys = rows.groupBy(*exact_dedup.LEVEL).count().where("count > 1").drop("count")
    bitmap = exact_dedup._Bitmap(keys)
    there, gone = bitmap.split(rows, True), bitmap.split(rows, False)
    assert there.join(keys, exact_dedup.LEVEL).count() == 2000 and there.count() + gone.count() == 5000
    assert gone.count() > 2500  # few false ones


def test_drop_duplicates_of_null_and_reused_ids(spark):
    head = "x" * 300  # same length and prefix hash, other texts
    rows = [(None, "a"), (None, "a"), (3, "a"), (None, "b"), (None, "b"), (None, "c"), (None, head + "1"), (None, head + "2"),
            (4, head + "1"), (5, "p"), (5, "q"), (5, "q"), (2, "q"), (6, "r"), (6, "r"), (6, "s"), (7, None), (8, " "), (9, "\n")]
    got = rows_of(exact_dedup.drop_duplicates(table(spark, rows).repartition(4)))
    want = [(3, "a"), (None, "b"), (None, "c"), (None, head + "2"), (4, head + "1"), (5, "p"), (2, "q"), (6, "r"), (6, "s"),
            (7, None), (8, " ")]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert exact_dedup.drop_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("chunk, blocks, lead", [(512, 16, 64), (4, 2, 3), (3, 0, 2)])
def test_near_duplicates(spark, monkeypatch, chunk, blocks, lead):
    """Small limits send clusters through blocks and through runs."""
    for name, value in (("CHUNK", chunk), ("BLOCKS", blocks), ("ALL_LEAD", lead)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(chunk)
    rows = [r for r in edge_rows() if r[0] != 15]
    base = [f"b{i}" for i in range(120)]
    for i in range(60):  # near copies around the threshold, and a passage that all share
        words = list(base)
        for k in rng.sample(range(120), rng.randrange(0, 8)):
            words[k] = f"x{i}_{k}"
        rows.append((100 + i, " ".join(words)))
        rows.append((200 + i, " ".join([f"u{i}_{k}" for k in range(40)] + base[:30])))
    rng.shuffle(rows)
    want = brute.components(rows)
    got = rows_of(ngram_join.near_duplicates(table(spark, rows).repartition(4)))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(got) == len(rows)


def test_size_of_turns_is_that_of_their_rows(spark, monkeypatch):
    """The planner's size of a turn's rows does not come from the plans behind it."""
    for name, value in (("CHUNK", 3), ("BLOCKS", 0), ("ALL_LEAD", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    sizes, plain = [], ngram_join._with_leaders

    def spied(*args):
        sizes.append(int(str((out := plain(*args))._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())))
        return out

    monkeypatch.setattr(ngram_join, "_with_leaders", spied)
    rows = [(i, " ".join([f"u{i}_{k}" for k in range(8)] + [f"b{k}" for k in range(40)])) for i in range(24)]
    assert {r["component_id"] for r in rows_of(ngram_join.near_duplicates(table(spark, rows)))} == set(range(24))
    assert len(sizes) > 3 and max(sizes[2:]) < 1e15  # the first two turns read what is not from a turn


def test_near_duplicates_edges(spark, edges):
    got = rows_of(ngram_join.near_duplicates(edges))
    assert len(got) == edges.count()
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3, 19)} == {1, 2, 3, 19}
    assert ngram_join.near_duplicates(empty(spark)).count() == 0
    kept = ngram_join.drop_near_duplicates(edges)
    assert kept.columns and not {11, 12, 14} & {r["doc_id"] for r in rows_of(kept)}


def test_remove_repeats(spark, edges):
    rng = random.Random(8)
    passage = [" ".join(rng.choices([f"p{i}" for i in range(50)], k=k)) for k in (13, 14, 40)]
    rows = [r for r in edge_rows() if r[0] != 15]
    for i in range(40):
        parts = [" ".join(rng.choices([f"q{i}" for i in range(300)], k=rng.randrange(0, 30))) for _ in range(3)]
        rows.append((300 + i, f"{parts[0]} {rng.choice(passage)} {parts[1]} {rng.choice(passage)} {parts[2]}"))
    rows += [(400, "a a " * 30), (401, "a a " * 20 + "b"), (402, "A a " * 20)]
    want = brute.repeats(rows)
    got = rows_of(repeats.remove_repeats(table(spark, rows).repartition(4), digest=True))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    assert sum(w[1] > 0 for w in want.values()) > 30
    twice = [r for r in rows_of(repeats.remove_repeats(edges)) if r["doc_id"] == 15]
    assert len(twice) == 2 and all(r["n_removed"] == 0 for r in twice)
    assert repeats.remove_repeats(empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "x y " * 20), (3, "x y " * 20), (None, None)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in rows_of(repeats.remove_repeats(nulls))) == [0, 0, 0]


@pytest.mark.parametrize("tasks", [2, 16])  # the line is hot in each task, or in all together
def test_repeats_around_a_hot_line(spark, monkeypatch, tasks):
    """A line in all documents amid different words: its texts are dealt to several shards, with the same result."""
    rng = random.Random(12)
    line = "this line of ten words stands in each of them"
    other = [" ".join(rng.choices([f"h{i}" for i in range(400)], k=20)) for _ in range(12)]
    rows = []
    for i in range(200):
        before, after = (" ".join(rng.choices([f"g{i}" for i in range(300)], k=rng.randrange(0, 12))) for _ in range(2))
        rows.append((i, f"{before} {rng.choice(['', 'same three words', 'or two'])} {line} {rng.choice(['and on', 'so', ''])} {after} {rng.choice(other)}"))
    want = brute.repeats(rows)
    tables = []
    minima = repeats._minima
    monkeypatch.setattr(repeats, "_minima", lambda spans, window: minima(tables.append(spans) or spans, window))
    monkeypatch.setattr(repeats, "HOT_CLASSES", 20, raising=False)
    got = rows_of(repeats.remove_repeats(table(spark, rows).repartition(tasks), digest=True))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want
    groups = {}  # words that meet under one anchor
    for r in rows_of(tables[0]):
        for a, n in zip(np.frombuffer(r["anchors"], np.uint64).tolist(), r["sizes"]):
            groups[a] = groups.get(a, 0) + n
    assert max(groups.values()) < 1000


@pytest.mark.parametrize("seed", range(4))
def test_automaton_finds_the_smallest_id_of_each_window(seed):
    rng = random.Random(seed)
    spans = [[rng.randrange(3) for _ in range(rng.randrange(4, 12))] for _ in range(60)]
    automaton = repeats.Automaton()
    who = [rng.randrange(100) for _ in spans]
    for s, w in zip(spans, who):
        automaton.add(s, w)
    automaton.finish()
    for s in spans:
        want = [min(w for t, w in zip(spans, who) if any(t[k:k + 4] == s[i:i + 4] for k in range(len(t) - 3))) for i in range(len(s) - 3)]
        assert automaton.windows(s, 4) == want


def test_prefix_tree_agrees_with_all_pairs():
    rng = random.Random(3)
    sets = [tuple(sorted(rng.sample(range(40), rng.randrange(3, 30)))) for _ in range(120)]
    sizes = [len(s) + rng.randrange(0, 3) for s in sets]
    tree = ngram_join.Tree(sets, sizes)
    for s, n in zip(sets, sizes):
        want = [i for i, (t, m) in enumerate(zip(sets, sizes))
                if 100 * len(set(s) & set(t)) >= 75 * (n + m - len(set(s) & set(t)))]
        assert sorted(tree.link(s, n, 75)) == want


URLS = ["http://A.Example.NET/en/x?q=1", "https://example.net/de/", "http://example.net", "http://net/", "http://notexample.net/en/",
        "http://x.org/fr/1#a", "http://org/fr/", "http://x.org/FR/", "http://a.example.com/de/", "http://example.com/en/", None, "", "no scheme",
        "ftp://?x", "http://a.b.c.example.net/en/../", "x://y://example.net/en/"]


def test_url_rules(spark):
    from florafold.llm.queries import URL_RULES
    rules = spark.createDataFrame(URL_RULES + [("deep.example.net", "/en/private/", "block"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string")

    def want(url):
        if not url or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = brute.ascii_lower(rest[:cut]), rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        hits = [(len(h + p), h + p, v) for h, p, v in URL_RULES + [("deep.example.net", "/en/private/", "block")]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(hits)[1:] if hits else (None, "allow")))

    for size in (200_000, 2):  # one block of rules, and several
        got = rows_of(url_filter.judge_urls(df, rules, block_rules=size))
        assert len(got) == len(URLS) * 2
        for r in got:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == want(r["url"])
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in rows_of(url_filter.judge_urls(df, rules.limit(0)))} == {"allow"}


def test_licenses(spark, edges):
    texts = ["GNU General Public License", "the MIT  License, MIT-License", "cc by CC-BY", "apache\nlicense", None, "", "mitlicense mit licensé",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
             " (the \"Software\"), to deal in the Software without restriction",
             "Permission is hereby granted, free of charge, to any one obtaining a copy of this software and associated documentation files"
             " to deal in the Software without restriction", "SPDX-License-Identifier: MIT"]
    df = table(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r for r in rows_of(license_scan.scan_licenses(df))}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute.license_base(t, license_scan.PHRASES)
    assert got[7]["labels"] == "mit-notice" and got[8]["labels"] == "" and got[9]["labels"] == "spdx"
    assert got[7]["score"] == 1.0 and got[0]["score"] == 0.5 and got[4]["score"] == 0.0
    assert license_scan.scan_licenses(edges).count() == edges.count()
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def test_template_regions():
    a = license_scan.Automaton("x <<optional>>y z<</optional>> <<any 2>> end")
    run = lambda text: a.run(text.encode().split().__getitem__, 0, len(text.split()))
    assert run("x end") == 2 and run("x y z end") == 4 and run("x q end") == 3 and run("x y z p q end") == 6
    assert run("x p q r end") is None and run("x y") is None and run("y end") is None


CC_NOTICES = ["Attribution", "Attribution-ShareAlike", "Attribution-NoDerivatives", "Attribution-NonCommercial",
              "Attribution-NonCommercial-ShareAlike", "Attribution-NonCommercial-NoDerivatives"]
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
# with the License. You may obtain a copy of the License at
#     {}
# Unless required by applicable law or agreed to in writing, software"""


def test_notices_with_long_regions(spark):
    texts = [f"This work is licensed under a Creative Commons {x} 4.0 International License." for x in CC_NOTICES]
    texts += ["licensed under a Creative Commons Attribution-Non-Commercial-Share-Alike 4.0 (CC-BY-NC-SA 4.0) International License"]
    cc = len(texts)
    texts += [APACHE.format(f"https://www.apache.org/licenses/LICENSE-2.0{x}") for x in ("", ".txt", ".html")]
    texts += [APACHE.format("https://git.example.org/some/group/project/blob/main/third/party/licenses/apache/LICENSE-2.0.txt?raw=true&x=1")]
    texts += ["licensed under a Creative Commons Attribution 4.0 license " + "and more words " * 20,
              APACHE.format("x").replace("agreed", "consented"), "licensed under a Creative Commons Attribution " * 3000]
    got = {r["doc_id"]: r for r in rows_of(license_scan.scan_licenses(table(spark, list(enumerate(texts)))))}
    for i, t in enumerate(texts[:-3]):
        label = "cc-notice" if i < cc else "apache-2.0-notice"
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0, t
    assert [got[len(texts) - k]["labels"] for k in (3, 2, 1)] == ["", "apache", ""]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def test_whole_licences_and_changed_ones(spark):
    texts = [MIT, ISC, MIT.replace("without limitation", "for non-commercial use only"), ISC.replace("appear in all", "and a fee go with all")]
    got = {r["doc_id"]: r["labels"] for r in rows_of(license_scan.scan_licenses(table(spark, list(enumerate(texts)))))}
    assert got == {0: "mit-notice,mit-whole", 1: "isc-notice,isc-whole", 2: "mit-notice", 3: "isc-notice"}


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:
{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
{2}
THIS SOFTWARE IS PROVIDED BY THE {3} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {3} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
NEITHER = "Neither the name of the {0} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_2 = BSD.format("1. ", "2. ", "", "COPYRIGHT HOLDERS AND CONTRIBUTORS")
BSD_3 = BSD.format("(a) ", "(b) ", "(c) " + NEITHER.format("Foo Bar Institute, Inc."), "REGENTS AND CONTRIBUTORS")
GPL_3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that
it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""
APACHE_2 = APACHE.format("http://www.apache.org/licenses/LICENSE-2.0") + """ distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
MPL_2 = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and
to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must
not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution."""
LICENCES = [(BSD_2, "bsd-2-whole", "with the distribution", "with the paid distribution"), (BSD_3, "bsd-3-whole", "specific prior", "prior"),
            (GPL_3, "gpl-3.0-header", "either version 3", "only version 3"), (APACHE_2, "apache-2.0-header", "limitations", "further limitations"),
            (MPL_2, "mpl-2.0-header", "v. 2.0. If", "v. 1.1. If"), (ZLIB, "zlib-whole", "including commercial", "excluding commercial")]


def test_whole_wordings_and_changed_ones(spark):
    whole = lambda labels: {x for x in labels.split(",") if x.endswith(("-whole", "-header"))}
    texts = [t.replace(a, b) if changed else f"Some words. {t} And others." for t, _, a, b in LICENCES for changed in (False, True)]
    assert len(set(texts)) == 2 * len(LICENCES)
    got = {r["doc_id"]: r for r in rows_of(license_scan.scan_licenses(table(spark, list(enumerate(texts)))))}
    for i, (_, label, _, _) in enumerate(LICENCES):
        assert whole(got[2 * i]["labels"]) == {label} and got[2 * i]["score"] == 1.0, label
        assert whole(got[2 * i + 1]["labels"]) == set(), label


def test_listed_words():
    a = license_scan.Automaton("x <<of p q>> end")
    run = lambda text: a.run(text.encode().split().__getitem__, 0, len(text.split()))
    assert run("x end") == 2 and run("x p q q p end") == 6 and run("x p r end") is None and run("x p") is None
    b = license_scan.Automaton("<<of 1 a>> end")
    assert b.starts - {b""} == {b"1", b"a", b"end"} and not b.prefix and a.prefix == [b"x"]
    with pytest.raises(ValueError):
        license_scan.Automaton("x <<some>> end")


def test_cc_notice_holds_only_words_of_its_kind(spark):
    far = "licensed under a Creative Commons Attribution license. " + "and more words " * 1700 + "international license"
    assert rows_of(license_scan.scan_licenses(table(spark, [(1, far)])))[0]["labels"] == ""


def test_free_loops():
    a = license_scan.Automaton("x <<optional>>y <<any>><</optional>> p <<any>> end")
    run = lambda text, dead=None: a.run(text.encode().split().__getitem__, 0, len(text.split()), dead)
    assert run("x p end") == 3 and run("x y p end") == 4 and run("x y a b c p d e end end") == 9
    assert run("x a p end") is None and run("x y a end") is None
    dead = {}
    assert run("x p a b", dead) is None and list(dead.values()) == [2]
    assert license_scan.Automaton("<<any>> end").run(b"a b end".split().__getitem__, 0, 3) == 3


PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var t="</p><p>not this</p>";</script></head><body class="page">
<header><a href=/>Site name of some length here</a></header><nav><ul><li><a href=1>Home</a><li><a href=2>About us</a></ul></nav>
<div class="cookie-notice">We use cookies to make this page work in the way you want it to work today.</div>
<article><h1>A&amp;B &#233;</h1><p>First  paragraph with <b>bold</b> &lt;text&gt; and<br>a break.<p>Short.</p><!-- <p>gone</p> --><div class="ad">Buy this now, it is
cheap and it is good for all of you out there in the world</div><form><p>Your mail</p></form></article><aside>Related things that others have read</aside>
<div id="comments"><p>I think that this is a comment by a reader with quite a few words in it.</p></div><footer>&copy; 2024 some words in a footer</footer>"""


def test_html(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "u", "", "t"), (4, "u", "<article><p>cut &am", "t"),
                                (5, "u", "<p>" + "word " * 60 + "</p><!-- open", "t"), (6, "u", PAGE, "t")],
                               "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in rows_of(html_extract.extract_text(df))}
    assert got[1]["text"] == "A&B é\n\nFirst paragraph with bold <text> and a break.\n\nShort." == got[6]["text"]
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "cut &am" and got[5]["n_chars"] == 60 * 5 - 1
    assert html_extract.extract_text(df.limit(0)).count() == 0


WRAPPERS = ["<div id=page class='site has-sidebar'>", '<div class="no-sidebar">', "<div class='with-menu'>", '<div id="wrap" class="has-header page">',
            '<div class="page-with-sidebar">', '<div class="layout sidebar-right">', "<form id=aspnetForm class=page>", '<div class="site has_ads">',
            "<div class='site has-sidebar'><div class='no-header'>"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["article", "main"])
def test_html_in_wrappers(wrapper, inner):
    tree = html_extract.train_tree()
    page = PAGE.replace('<body class="page">', f'<body class="page">{wrapper}').replace("article>", f"{inner}>")
    plain = html_extract.main_text(PAGE.replace("article>", f"{inner}>"), tree)
    assert plain.startswith("A&B") and html_extract.main_text(page, tree) == plain


def test_html_parts_around_and_inside_an_article():
    tree = html_extract.train_tree()
    text = "Some words of this part that go on for a while so that it looks like text of its own here"
    for tag in ('<div id="comments">', '<section class="comments-area">', '<div class="ad-slot">', "<aside>", '<div class="sidebar">',
                '<div class="related-posts">', "<div class='comment has-children'>", "<div class=ad-with-image>"):
        end = tag[1:].split()[0].strip(">")
        for page in (f"{tag}<article><p>{text}</article></{end}>", f"<article><h1>T</h1><p>{text} x</p>{tag}<article><p>{text}</p></article></{end}></article>",
                     f"<article><p>{text} x</p>{tag}<p>{text}</p></{end}></article>"):
            got = html_extract.main_text(page, tree)
            assert text not in got.replace(f"{text} x", ""), (tag, page)
            assert (f"{text} x" in got) == (f"{text} x" in page), (tag, page)
    for tag in ('<div class="sidebar">', "<div class=search>"):
        assert html_extract.main_text(f"{tag}<main><p>{text}</p></main></div>", tree) == text


PARA = "The town council met on Tuesday to talk about the new bridge over the river, which has been closed since the flood of last spring. It stays so."


def _news(parts, before="<div>", after="</div>"):
    """A page without an article or main element around ``parts``."""
    return ("<html><head><title>T - S</title></head><body><div id=top><a href=/>Site</a></div><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul>"
            + before + "".join(parts) + after + "<ul><li><a href=4>Terms</a></li><li><a href=5>Privacy</a></li></ul><p>Copyright 2024 Site</p></body></html>")


NEWS = ["<h1>Bridge to open again</h1>", "<p>After two years of work the bridge opens.</p>", *[f"<p>{PARA} {i}</p>" for i in range(4)], "<h2>What comes next</h2>",
        f"<p>{PARA}</p>", "<p>It opens on Monday.</p>"]


@pytest.mark.parametrize("before,after", [("<div>", "</div>"), ('<div class="sidebar-right">', "</div>"), ("<div id=page class='layout menu-left'><div>", "</div></div>"),
                                          ("<div>", "</div><div class=sidebar-left><p>Other things that others have read in the last days here</p></div>")])
def test_html_without_an_article(before, after):
    want = "\n\n".join(p[p.index(">") + 1:p.rindex("<")] for p in NEWS)
    assert html_extract.main_text(_news(NEWS, before, after), html_extract.train_tree()) == want


def test_html_quotes_references_and_inline_adverts():
    tree = html_extract.train_tree()
    cases = [(f"<p data-x=it's>{PARA}</p>", PARA), (f'<p title="a>b" data-y=\'c>d\'>{PARA}</p>', PARA), (f"<p title = \"x>y\">{PARA}</p>", PARA),
             (f"<p title='open>{PARA}</p>", PARA), (f"<p>{PARA} <span class=\"ad\">Buy this <b>now</b></span> and so on</p>", f"{PARA} and so on"),
             (f"<p>{PARA} <a class=sponsored href=x>Buy this</a></p>", PARA), (f"<p>{PARA} &am<b>p;</b> &amp;amp; &#65;</p>", f"{PARA} &amp; &amp; A")]
    for part, want in cases:
        got = html_extract.main_text(f"<body><article><h1>T</h1>{part}<p>{PARA} z</p></article></body>", tree)
        assert got == f"T\n\n{want}\n\n{PARA} z", part


def test_html_of_all_pages(spark):
    import html
    import re
    for r in E.queries()["op10_html_extraction"](spark, SF).join(load_table(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts}
    by_sequence = {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == r["piece"] * capacity and len(part) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0] + [n for _, n in parts[:-1]]))
        assert sum(n for _, n in parts) <= capacity
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
    return len(by_sequence)


def test_packing(spark, edges):
    rows = [r for r in edge_rows() if r[0] != 15] + [(50, "<|endoftext|> a<|startoftext|>b"), (51, "ΣΑΣ İstanbul e\u0301 don't I'LL ½ \x1c\x85")]
    got = rows_of(packing.pack_documents(table(spark, rows).repartition(3), tokenizer_path(), capacity=4096))
    check_packing(got, rows, 4096)
    got = rows_of(packing.pack_documents(table(spark, rows), tokenizer_path(), capacity=64, group_rows=100))
    check_packing(got, rows, 64)
    assert packing.pack_documents(empty(spark), tokenizer_path()).count() == 0
    assert packing.pack_documents(edges, tokenizer_path()).where("doc_id = 15").count() == 2


def test_packing_of_documents_is_tight(spark):
    docs = [(r["doc_id"], r["text"]) for r in load_table(spark, SF, "documents").collect()]
    got = rows_of(E.queries()["op8_packing"](spark, SF))
    n = check_packing(got, docs, 4096)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 2


def test_sum_of_squares_picks_the_least_sum():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 11, 300)
    sequence, offset = packing.sum_of_squares(lengths, 10)
    gaps = {}
    for i, n in enumerate(lengths.tolist()):
        cost = lambda g: sum(list(g.values()).count(x) ** 2 for x in range(1, 10))
        choices = {k: cost({**gaps, k: gaps[k] - n}) for k in gaps if gaps[k] >= n}
        fresh = cost({**gaps, -1: 10 - n})
        at = int(sequence[i])
        got = choices[at] if at in gaps else fresh
        assert got == min([*choices.values(), fresh]) and offset[i] == (10 - gaps[at] if at in gaps else 0)
        gaps[at] = gaps.get(at, 10) - n


def test_language_id(spark, edges):
    docs = load_table(spark, "/root/testdata/sf0.01", "documents")
    got = E.queries()["op7_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert sum(not r["accepted"] for r in got) <= 0.01 * len(got)
    model = language_id.fit(docs)
    seen = {r["doc_id"]: r for r in rows_of(language_id.predict(edges.where("doc_id <> 15"), model))}
    for d in (1, 2, 3, 18, 19):
        assert (seen[d]["lang_pred"], seen[d]["score"], seen[d]["accepted"]) == ("und", 0.0, False)
    assert seen[16]["lang_pred"] in model.languages and 0 <= seen[16]["score"] <= 1
    assert language_id.predict(empty(spark), model).count() == 0
    none = language_id.fit(edges.withColumn("lang", F.lit(None).cast("string")))
    assert none is None and {r["lang_pred"] for r in rows_of(language_id.predict(edges, none))} == {"und"}


def test_language_training_holds_one_matrix(spark):
    """The driver's Python holds the sample's count vectors once, and less than them on the way."""
    import tracemalloc
    rng, letters = random.Random(2), ["abcdefg", "mnopqrs"]
    rows = [(i, " ".join("".join(rng.choices(letters[i % 2], k=5)) for _ in range(20)), "xy"[i % 2]) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.fit(docs)
    tracemalloc.start()
    model = language_id.fit(docs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == ["x", "y"] and most < 2 * 1200 * 2048 * 4


def test_toxicity(spark, edges):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in load_table(spark, sf, "labels").collect()}
    got = rows_of(E.queries()["op4_toxicity"](spark, sf))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    hit = sum(r["predicted"] and labels[r["doc_id"]] for r in held)
    assert hit >= 0.9 * sum(r["predicted"] for r in held) and hit >= 0.9 * sum(labels[r["doc_id"]] for r in held)
    model = toxicity.fit(edges, spark.createDataFrame([(4, 1), (4, 1), (7, 0), (None, 1), (99, 1), (1, None)], "doc_id long, toxic int"))
    seen = rows_of(toxicity.score_texts(edges, model))
    assert len(seen) == edges.count() and len({r["score"] for r in seen if r["doc_id"] in (1, 2, 3, 19)}) == 1
    assert toxicity.score_texts(empty(spark), model).count() == 0
    assert toxicity.fit(empty(spark), spark.createDataFrame([], "doc_id long, toxic int")).score(pa.array(["x", None])).max() < 0.5


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    votes = np.zeros((4000, 5), int)
    for k, (hit, wrong) in enumerate([(0.9, 0.01), (0.7, 0.05), (0.6, 0.02), (0.5, 0.3)]):
        votes[:, k] = np.where(y, rng.random(4000) < hit, rng.random(4000) < wrong)
    votes[:, 4] = votes[:, 3]  # the same voter twice
    post, weight = toxicity.label_model(votes, 0.2)
    assert ((post > 0.5) == y).mean() > 0.95 and weight[4] < weight[0]


def edited(text, rng, every):
    words = text.split()
    for k in range(rng.randrange(every), len(words), every):
        words[k] = "other"
    return " ".join(words)


def test_decontamination(spark, edges):
    rng = random.Random(4)
    items = [(r["item_id"], r["text"]) for r in load_table(spark, SF, "benchmark").collect()]
    noise = [" ".join(rng.choices([f"n{i}" for i in range(500)], k=120)) for _ in range(40)]
    rows, want = [], set()
    for i, (item, text) in enumerate(items[:20]):
        rows.append((i, f"{noise[i]} {text} {noise[i + 1]}"))
        rows.append((100 + i, f"{noise[i]} {edited(text, rng, 8)} {noise[i]}"))
        rows.append((200 + i, " ".join(text.split()[:5]) + " " + noise[i]))
        want |= {(i, item), (100 + i, item)}
    bench = spark.createDataFrame(items + [(900, None), (901, ""), (902, "short item")], "item_id long, text string")
    docs = table(spark, rows + [(300, "a short item here"), (301, None), (302, "")])
    for words in (1_000_000, 500):  # one block of items, and several
        got = {(r["doc_id"], r["item_id"]) for r in rows_of(decontaminate.find_items(docs, bench, block_words=words))}
        assert got == want | {(300, 902)}
    clean = {r["doc_id"] for r in rows_of(decontaminate.drop_contaminated(docs, bench))}
    assert clean == {200 + i for i in range(20)} | {301, 302}
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    for words in (1_000_000, 500):
        left = decontaminate.drop_contaminated(nameless, bench, block_words=words)
        assert left.columns == docs.columns and left.count() == len(clean)
    assert decontaminate.drop_contaminated(empty(spark), bench).count() == 0
    assert decontaminate.find_items(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_items(empty(spark), bench).count() == 0
    assert decontaminate.find_items(edges, bench).count() == 0


def test_decontamination_does_not_depend_on_how_often_an_item_is_copied(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    words = item.split()
    rows = [(i, f"x{i} {item} y{i}") for i in range(5)]
    rows += [(10 + i, f"x{i} {' '.join(words[:6])} y{i}") for i in range(5)]  # the 4-grams at places 3 and 4 are the rarest
    rows += [(20, "p q " + " ".join([*words[:5], "other", *words[6:]]) + " r s"), (21, " ".join(words[:4]) + " p q r s")]
    docs, bench = table(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string")
    want = {i: 1.0 for i in range(5)} | {10 + i: 0.75 for i in range(5)} | {20: 0.75}
    for rare in (0, 4, 1000):
        got = rows_of(decontaminate.find_items(docs, bench, rare_documents=rare))
        assert {r["doc_id"]: r["score"] for r in got} == want and len(got) == len(want)
        assert [r["doc_id"] for r in rows_of(decontaminate.drop_contaminated(docs, bench, rare_documents=rare))] == [21]


@pytest.mark.parametrize("rare", [0, 3])
def test_decontamination_finds_what_plain_alignment_finds(rare):
    rng = random.Random(rare)
    items = [[f"v{rng.randrange(60)}" for _ in range(rng.randrange(4, 30))] for _ in range(8)]
    texts = []
    for _ in range(300):
        copy = [w for w in rng.choice(items) for w in ([w], [w], [w], [w], [], ["new"], [w, "new"])[rng.randrange(7)]]
        texts.append([f"v{rng.randrange(60)}" for _ in range(20)] + copy + [f"v{rng.randrange(60)}" for _ in range(20)])
    seeds = decontaminate.Seeds([(k, " ".join(x)) for k, x in enumerate(items)], 4)
    seeds.rate({int(g): 2 for g in seeds.hash}, rare)
    got = decontaminate._aligned(pa.array([" ".join(t) for t in texts]), seeds, 0.6)
    grams_of = lambda x: {tuple(x[i:i + 4]) for i in range(len(x) - 3)}
    want = {(d, k): s for d, t in enumerate(texts) for k, x in enumerate(items)
            if grams_of(x) & grams_of(t) and (s := decontaminate.smith_waterman(*(np.array([hash(w) for w in y]) for y in (x, t)))[0]) >= 0.6 * len(x)}
    assert {x: r[0] for x, r in got.items()} == want and len(want) > 20


@pytest.mark.parametrize("min_score, rare", [(0.6, 0), (0.6, 3), (0.45, 1), (0.8, 0), (1.0, 0)])
def test_decontamination_loses_no_copy_above_the_score(min_score, rare):
    """Words dropped, put in and replaced at random: every (text, item) pair that plain alignment scores high enough."""
    rng = random.Random(f"{min_score} {rare}")
    items = [[f"v{rng.randrange(90)}" for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    texts = [[w for i, w in enumerate(items[k]) for w in ([w, "new"] if i % every == every - 1 else [w])] for k in range(12) for every in (2, 3, 4)]
    for _ in range(500):
        copy = [w for w in rng.choice(items) for w in ([w], [w], [w], [w], [w], [], ["new"], [w, "new"])[rng.randrange(8)]]
        texts.append([f"v{rng.randrange(90)}" for _ in range(15)] + copy + [f"v{rng.randrange(90)}" for _ in range(15)])
    seeds = decontaminate.Seeds([(k, " ".join(x)) for k, x in enumerate(items)], None, min_score)
    seeds.rate({int(g): 2 for g in seeds.hash}, rare)
    got = decontaminate._aligned(pa.array([" ".join(t) for t in texts]), seeds, min_score)
    want = {}
    for d, t in enumerate(texts):
        for k, x in enumerate(items):
            s = decontaminate.smith_waterman(*(np.array([hash(w) for w in y]) for y in (x, t)))[0]
            if s / len(x) >= (min_score if len(x) >= decontaminate.WHOLE_BELOW else 1):
                want[d, k] = s
    assert {x: r[0] for x, r in got.items()} == want and len(want) > 20
    fours = {(d, k) for d, k in want if any(" ".join(items[k][i:i + 4]) in " ".join(texts[d]) for i in range(len(items[k]) - 3))}
    assert min_score > 0.7 or len(fours) < len(want)  # some have no four unchanged words


def test_decontamination_finds_an_item_with_a_word_put_in_after_each_third(spark):
    item = [f"w{i}" for i in range(30)]
    copy = " ".join(w + " extra" if i % 3 == 2 else w for i, w in enumerate(item))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = rows_of(decontaminate.find_items(table(spark, [(1, f"a b {copy} c d"), (2, "nothing of it")]), bench))
    assert [(r["doc_id"], r["item_id"], r["score"], r["first_word"], r["words"]) for r in got] == [(1, 1, 0.7, 2, 39)]
    assert rows_of(decontaminate.find_items(table(spark, [(1, copy)]), bench, n=4)) == []


def plain_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_agrees_with_the_plain_table():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64) for _ in range(2))
        assert decontaminate.smith_waterman(a, b)[0] == plain_alignment(a, b)
