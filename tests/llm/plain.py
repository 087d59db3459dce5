"""Helpers of these tests."""

import re

SF_DIR = "/root/testdata/sf0.001"


def by_id(rows, doc_id):
    return next(r for r in rows if r.doc_id == doc_id)


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
