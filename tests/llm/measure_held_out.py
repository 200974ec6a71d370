"""Held-out figures of the fitted operators: python tests/llm/measure_held_out.py [folder of tables].

Quality counts errors on labelled rows that pass the base rules (2,000 of them train it); toxicity and language
count held-out rows only; a page's main text is taken from its article element, without adverts, comments, related links and forms.
"""

import html
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quaver.llm import queries  # noqa: E402
from quaver.session import local_session, table  # noqa: E402

SIDE = re.compile(r'<aside.*?</aside>|<div class="(?:ad|comments|related)[^>]*>.*?</div>|<form.*?</form>', re.DOTALL)
BREAK = re.compile(r"</?(?:h1|h2|p|br|ul|li|blockquote|div|table|tr|td|section)\b[^>]*>")


def main_text(page: str) -> str:
    body = SIDE.sub("\n", re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1])
    found = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in BREAK.split(body))
    return "\n".join(x for x in found if x)


def measure(folder: str) -> None:
    spark = local_session("measure")
    spark.sparkContext.setLogLevel("ERROR")
    labels = {r.doc_id: r for r in table(spark, folder, "labels").collect()}
    langs = {r.doc_id: r.lang for r in table(spark, folder, "documents").select("doc_id", "lang").collect()}
    rows = [(labels[r.doc_id].quality, r.kept) for r in queries.op2_quality_rules(spark, folder).collect() if r.doc_id in labels and labels[r.doc_id].quality is not None and not r.base_failed]
    print(f"quality: {sum((q == 1) != k for q, k in rows)} errors of {len(rows)} labelled rows that pass the base rules")
    rows = [(labels[r.doc_id].toxic, r.predicted) for r in queries.op6_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels and labels[r.doc_id].toxic is not None]
    print(f"toxicity: {sum(a and b for a, b in rows)} of {sum(a for a, _ in rows)} toxic rows found, {sum(b and not a for a, b in rows)} of {sum(not a for a, _ in rows)} others flagged")
    rows = [(langs[r.doc_id], r.lang_pred) for r in queries.op7_language_id(spark, folder).collect() if r.held_out and langs[r.doc_id]]
    print(f"language: {sum(a != b for a, b in rows)} errors of {len(rows)}")
    pages = {r.page_id: main_text(r.html) for r in table(spark, folder, "pages").collect() if "<article>" in (r.html or "")}
    rows = [r.text == pages[r.page_id] for r in queries.op8_html_extraction(spark, folder).collect() if r.page_id in pages]
    print(f"main text: exact on {sum(rows)} of {len(rows)} pages")
    spark.stop()


if __name__ == "__main__":
    measure(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
