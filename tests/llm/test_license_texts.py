"""Licence texts and look-alikes that are not made of the templates: paragraphs as they stand in files, and prose about them."""

import pytest

from adjudica.llm import license_scan

MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:'
TEXTS = {
    "mit": [MIT, "// " + MIT.replace("\n", "\n// "), 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'],
    "boost-1": [
        'Permission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the "Software") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:',
        "IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ofl-1": ["Permission is hereby granted, free of charge, to any person obtaining\na copy of the Font Software, to use, study, copy, merge, embed, modify,\nredistribute, and sell modified and unmodified copies of the Font\nSoftware, subject to the following conditions:", "This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "gpl-3": ["The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n\n  The licenses for most software and other practical works are designed\nto take away your freedom to share and change the works.", "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007"],
    "gpl-2": ["  The licenses for most software are designed to take away your\nfreedom to share and change it.  By contrast, the GNU General Public\nLicense is intended to guarantee your freedom to share and change free\nsoftware--to make sure the software is free for all its users."],
    "agpl-3": ["The GNU Affero General Public License is a free, copyleft license for\nsoftware and other kinds of works, specifically designed to ensure cooperation"],
    "apache-2": ["Subject to the terms and conditions of\nthis License, each Contributor hereby grants to You a perpetual,\nworldwide, non-exclusive, no-charge, royalty-free, irrevocable\ncopyright license to reproduce, prepare Derivative Works of,\npublicly display, publicly perform, sublicense, and distribute the\nWork and such Derivative Works in Source or Object form."],
}
#: nothing in these grants anything
OTHERS = [
    "Permission is hereby granted to the tenant to keep one dog, free of charge, in any room obtaining light.", "The software is provided to staff as is, and the above notice shall be included in all letters.",
    "We compared several licenses for most software and found their terms alike; the general public read none.", "In no event shall the copyright of a song be sold by anyone distributing it.", "A copy of the font software arrived; any person may look at it in the library.",
    "Subject to the terms and conditions of this agreement each party grants the other a non exclusive right to use its name.", "The general public is free to visit; a license for other kinds of works is sold at the door.", "mit boost apache gnu license version 2 3 free software",
]


@pytest.fixture(scope="module")
def found(spark):
    texts = [(label, t) for label, some in TEXTS.items() for t in some] + [(None, t) for t in OTHERS]
    rows = [(i, f"Some words before. {t} And after." if i % 2 else t) for i, (_, t) in enumerate(texts)]
    got = {r.doc_id: r.labels for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [(label, got[i]) for i, (label, _) in enumerate(texts)]


def test_texts_have_their_own_label_and_no_other(found):
    assert [(label, labels) for label, labels in found if label and labels != [label]] == []


def test_other_texts_have_none(found):
    assert [labels for label, labels in found if label is None and labels] == []
