"""Unmodified notices, wrapped as they are published."""

import pytest

from broadsheet.llm import licenses

MIT = '''MIT License

Copyright (c) 2020 Some Person

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
'''
BSD = '''Copyright (c) 2020, Some Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION).
'''
APACHE = '''Copyright 2020 Some Person

Licensed under the Apache License, Version 2.0 (the "License"); you may not
use this file except in compliance with the License. You may obtain a copy of
the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
'''
GPL = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
'''
NOTICES = {"MIT": MIT, "BSD": BSD, "Apache-2.0": APACHE, "GPL-3.0": GPL}


def scanned(spark, texts):
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return {r.doc_id: (r.sentence_ids, r.licenses) for r in got}


def commented(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.splitlines())


@pytest.mark.parametrize("name", NOTICES)
def test_notices(spark, name):
    text = NOTICES[name]
    forms = [text, " ".join(text.split("\n")), text.replace("\n", "\r\n"), commented(text, "#"), commented(text, " *"), f"Some title\n{text}And more"]
    assert {licences for _, licences in scanned(spark, forms).values()} == {name}


def test_parts_of_the_notices(spark):
    got = scanned(spark, [MIT, BSD, APACHE, GPL])
    assert [got[i][0] for i in range(4)] == [
        "mit-grant|mit-notice|mit-warranty|mit-liability",
        "reserved|bsd-grant|bsd-source|bsd-binary|bsd-name|bsd-warranty|bsd-liability",
        "apache-head|apache-use|apache-copy", "gpl3-free|gpl-hope"]


def test_phrases_inside_sentences(spark):
    got = scanned(spark, [
        "The code here is licensed under\nthe MIT License and nothing else.", "All rights\nreserved", "unlicensed under the MIT licenses",
        "a\nReleased under the MIT License\nThis work is licensed under the GNU General Public License, version 3\nb",
        "word " * 2000 + "released under the MIT License " + "word " * 2000])
    assert [got[i] for i in range(5)] == [
        ("mit-ref", "MIT"), ("reserved", "proprietary"), ("", ""), ("mit-ref|gpl3-ref", "MIT,GPL-3.0"), ("mit-ref", "MIT")]


def test_tables():
    import re

    assert all(re.search(licenses.NEAR, p) and re.search(licenses.KNOWN, p) for p in licenses.PHRASES)
    assert [len(r[0]) for r in licenses.SEQUENCES] == sorted((len(r[0]) for r in licenses.SEQUENCES), reverse=True)
