"""One registered query for each operator of this package, over its whole table, with its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaybook.llm import chat, decontaminate, lexical, licenses, merkle, mixing, neighbours, quality
from relaybook.llm import shards, simhash, tokens, toxicity, urls
from relaybook.llm.common import table
from relaybook.queries.registry import Run

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

#: The rules that the URL query judges by, as (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
#: The licence statements that the licence query looks for.
LICENSE_TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("LicenseRef-all-rights-reserved", "All rights reserved."),
    # Standard notices, and the text of a licence that is itself the notice.
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE."""),
]
SHARDS = 40
#: The turns added to the conversations, which hold control strings.
ADDED_CONVERSATION, ADDED_TEXT = -7, "\\### Assistant: </turn> ok"


def register(sql: str | None = None):
    def add(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""


def _due_sql(share: str, knots) -> str:
    """The inverse of a schedule, as ``mixing.due`` computes it."""
    total = sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False))
    found, high = None, total
    for (t0, w0), (t1, w1) in reversed(list(zip(knots, knots[1:], strict=False))):
        low = sum((a1 + b1) / 2 * (b0 - a0) for (a0, a1), (b0, b1) in zip(knots, knots[1:], strict=False) if b0 <= t0)
        slope = 2 * (w1 - w0) / (t1 - t0)
        amount = f"({share} * {total!r}::DOUBLE)"
        left = f"greatest({amount} - {low!r}::DOUBLE, 0.0::DOUBLE)"
        root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {left} * {slope!r}::DOUBLE, 0.0::DOUBLE))"
        at = (f"least(CASE WHEN {left} > 0 THEN {t0!r}::DOUBLE + {left} * 2 / ({w0!r}::DOUBLE + {root}) "
              f"ELSE {t0!r}::DOUBLE END, {t1!r}::DOUBLE)")
        found = at if found is None else f"CASE WHEN {amount} < {high!r}::DOUBLE THEN {at} ELSE {found} END"
        high = low
    return found


def mix_sql(documents: str = "documents") -> str:
    """Rows of the mix as SQL; ``row_key`` orders the documents of a source."""
    first = "least(start / target, 1.0::DOUBLE)"
    second = "least((source_size + start) / target, 1.0::DOUBLE)"

    def position(share: str) -> str:
        cases = " ".join(f"WHEN {n} THEN {_due_sql(share, knots)}" for n, knots in enumerate(mixing.SCHEDULES))
        return f"CASE turn {cases} END"

    weights = " ".join(f"WHEN {n} THEN {w!r}::DOUBLE" for n, w in enumerate(mixing.WEIGHTS))
    return f"""
    WITH sized AS (
        SELECT *, len({_WORDS})::BIGINT AS size,
            md5(coalesce('=' || doc_id, '-') || chr(10) || coalesce('=' || source, '-') || chr(10)
                || coalesce('=' || text, '-')) AS row_key
        FROM {documents}),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS turn
        FROM sized GROUP BY source),
    weighted AS (
        SELECT *, CASE turn {weights} END AS weight, source_size * {mixing.MOST} AS cap,
            sum(source_size) OVER () * {mixing.SHARE!r}::DOUBLE AS wanted, sum(1.0::DOUBLE) OVER () AS n
        FROM sources),
    leveled AS (
        SELECT *, (wanted - coalesce(sum(cap) OVER earlier, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0.0::DOUBLE)) AS level,
            row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank
        FROM weighted
        WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    chosen AS (SELECT arg_min(level, rank) AS level FROM leveled WHERE cap >= level * weight),
    aimed AS (
        SELECT source, source_size, turn,
            least(cap::DOUBLE, coalesce((SELECT level FROM chosen) * weight, cap::DOUBLE)) AS target
        FROM leveled),
    placed AS (
        SELECT sized.*, source_size, turn, target,
            coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY row_key
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM sized JOIN aimed ON sized.source IS NOT DISTINCT FROM aimed.source),
    counted AS (
        SELECT *, CASE WHEN size > 0 AND start + size / 2 < target THEN 1 ELSE 0 END
            + CASE WHEN size > 0 AND source_size + start + size / 2 < target THEN 1 ELSE 0 END AS copies
        FROM placed)
    SELECT *, (size * copies)::BIGINT AS taken,
        CASE WHEN copies > 0 THEN {position(first)} END AS first_position,
        CASE WHEN copies > 1 THEN {position(second)} END AS second_position
    FROM counted"""


@register(f"SELECT doc_id, size, source_size, target, taken, first_position, second_position FROM ({mix_sql()})")
def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    rows = mixed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.get("positions", F.lit(0)).alias("first_position"), F.get("positions", F.lit(1)).alias("second_position"),
    )
    # Documents in training order; those not taken come first, dealt out by id.
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


@register()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.count_tokens(documents, str(public_tokenizers.path("byte_bpe_50k.json")))


@register(f"""
    WITH split AS (
        SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    rules(verdict, rule_host, rule_path) AS (VALUES
        {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
    met AS (
        SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
            arg_max(verdict, length(rule_host || rule_path)) AS verdict
        FROM (SELECT DISTINCT host, path FROM split) JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path)
    SELECT page_id, split.host, split.path, rule, coalesce(verdict, 'allow') AS verdict
    FROM split LEFT JOIN met ON split.host = met.host AND split.path = met.path""")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge_urls(pages, urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register(rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES ({ADDED_CONVERSATION}, 0, 'user', '{ADDED_TEXT}'),
            ({ADDED_CONVERSATION}, 1, 'assistant', '{ADDED_TEXT}')),
    marked AS (
        SELECT *, coalesce(role <> lag(role) OVER w, true) AS opens,
            len(regexp_replace(role, '([\\<>])', '_\1', 'g')) AS role_chars,
            len(regexp_replace(text, '([\\<>])', '_\1', 'g')) AS text_chars
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
        sum(text_chars + CASE WHEN opens THEN role_chars + {len(chat.OPEN) + 1 + len(chat.CLOSE)} ELSE {len(chat.NEXT)} END)::BIGINT AS formatted_chars
    FROM marked GROUP BY conv_id""")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"),
    )
    return chat.digests(chat.format_chats(turns.unionByName(added)))


@register()
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shards.shard(documents, SHARDS, carry=["doc_id"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "next_shard"
    )


@register()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


@register()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(documents, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files of a tree: ``source/thousands/hundreds/name``.

    Every tenth is named a licence file; of these every hundredth lies one level higher and every
    thousandth at the top of its source.
    """
    doc_id = F.col("doc_id")
    thousands = F.floor(doc_id / 1000).cast("string")
    hundreds = (F.floor(doc_id / 100) % 10).cast("string")
    folder = (
        F.when(doc_id % 1000 == 0, F.col("source"))
        .when(doc_id % 100 == 0, F.concat_ws("/", "source", thousands))
        .otherwise(F.concat_ws("/", "source", thousands, hundreds))
    )
    name = F.when(doc_id % 10 == 0, F.concat(F.lit("LICENSE-"), doc_id.cast("string"))).otherwise(
        F.concat(doc_id.cast("string"), F.lit(".txt"))
    )
    return documents.select("doc_id", F.concat(folder, F.lit("/"), name).alias("path"), "text")


@register()
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(table(spark, sf_dir, "documents"))
    templates = spark.createDataFrame(LICENSE_TEMPLATES, "license string, text string")
    return licenses.scan_licenses(files, templates, carry=["doc_id", "path"]).select(
        "doc_id", "path", "header_license", "header_score", "inherited_license", "inherited_from", "license"
    )


_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)


def quality_sql(documents: str = "documents", keep: str = "doc_id") -> str:
    """Documents with the counts and verdicts of the quality rules, as SQL."""
    covered = ", ".join(f"'{name}'" for name in quality.COVERED)
    other = f" OR n_other_letters * 2 >= greatest(word_chars, 1) OR lang NOT IN ({covered})"
    rules = []
    for rule in quality.RULES:
        value = f"{rule.metric}::DOUBLE / greatest({rule.per}, 1)"
        if rule.at_least is not None:
            rules.append(f"{value} >= {rule.at_least}{other if rule.covered else ''}")
        if rule.at_most is not None:
            rules.append(f"{value} <= {rule.at_most}{other if rule.covered else ''}")
    return rf"""
    WITH split AS (
        SELECT *, {_WORDS} AS ws,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
        FROM {documents}),
    windows AS (
        SELECT *, list_transform(range(1, len(ws) - {quality.WINDOW - 2}),
            lambda i: array_to_string(ws[i:i + {quality.WINDOW - 1}], ' ')) AS vs
        FROM split),
    twice AS (
        SELECT *, list_transform(list_filter(map_entries(CASE WHEN len(list_distinct(vs)) < len(vs) THEN list_histogram(vs) ELSE MAP {{}} END), lambda e: e.value > 1), lambda e: e.key) AS ts
        FROM windows),
    starts AS (
        SELECT *, CASE WHEN len(ts) = 0 THEN [] ELSE list_filter(range(1, len(vs) + 1), lambda i: list_contains(ts, vs[i])) END AS ss
        FROM twice),
    counted AS (
        SELECT *, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars,
            len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
            (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            len(list_distinct(flatten(list_transform(ss, lambda s: range(s, s + {quality.WINDOW})))))::BIGINT AS n_repeat_words,
            len(ls)::BIGINT AS n_lines,
            len(list_filter(ws, lambda w: list_contains([{_STOP}], lower(w))))::BIGINT AS n_stop_words,
            len(regexp_extract_all(coalesce(text, ''), '[\x{{0370}}-\x{{1DFF}}\x{{2E80}}-\x{{D7FF}}\x{{F900}}-\x{{FAFF}}]'))::BIGINT AS n_other_letters
        FROM starts),
    based AS (
        SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
        FROM counted)
    SELECT {keep}, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words, n_other_letters, base_failed,
        NOT base_failed AND {" AND ".join(f"coalesce({rule}, false)" for rule in rules)} AS kept
    FROM based"""


@register(quality_sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), lang="lang")
    return judged.select("doc_id", *quality.METRICS, "base_failed", "kept")


@register(rf"""
    WITH split AS (
        SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
        FROM documents),
    items AS (
        SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
        FROM benchmark),
    phrases AS (
        SELECT DISTINCT item_id, least(len(ws), {decontaminate.WINDOW}) AS size, array_to_string(ws[i:i + {decontaminate.WINDOW - 1}], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, greatest(len(ws) - {decontaminate.WINDOW - 2}, 2))) AS i FROM items WHERE len(ws) > 0)),
    lengths AS (SELECT DISTINCT size FROM phrases),
    places AS (
        SELECT row, size, i, array_to_string(ws[i:i + size - 1], ' ') AS phrase
        FROM (SELECT row, size, ws, unnest(range(1, len(ws) - size + 2)) AS i FROM split, lengths WHERE len(ws) >= size)),
    met AS (SELECT row, i, places.size, item_id FROM places JOIN phrases ON places.phrase = phrases.phrase AND places.size = phrases.size),
    hits AS (SELECT row, count(DISTINCT word) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS word FROM met) GROUP BY row),
    named AS (SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM met GROUP BY row)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM split LEFT JOIN hits USING (row) LEFT JOIN named USING (row)""")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn(
        "contaminated", F.col("n_hit") > 0
    )


@register(r"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
        FROM documents),
    sizes AS (SELECT row, doc_id, len(ws)::BIGINT AS n FROM docs WHERE len(ws) > 0),
    stats AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sizes),
    items AS (
        SELECT row_number() OVER () AS item, item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
        FROM benchmark),
    asked AS (SELECT item, term, count(*)::BIGINT AS times FROM (SELECT item, unnest(ws) AS term FROM items) GROUP BY ALL),
    held AS (
        SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(ws) AS term FROM docs)
        WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
        SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM held, stats GROUP BY term),
    scored AS (
        SELECT item, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
        FROM held JOIN asked USING (term) JOIN weights USING (term) JOIN sizes USING (row), stats GROUP BY ALL),
    placed AS (
        SELECT item, row, score, doc_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, row)::INTEGER AS rank
        FROM scored JOIN sizes USING (row) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed JOIN items USING (item) WHERE rank <= 20""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _part_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def merkle_sql(documents: str = "documents") -> str:
    """Leaves, levels and proofs of the manifest as SQL; ``strlen`` counts bytes."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = " || ".join(_part_sql(name) for name in fields)
    changed = " || ".join(_part_sql("n_chars + tampered" if name == "n_chars" else name) for name in fields)
    bit = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    steps = ("flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
             "lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))")
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {bit}), 4294967295)"
    return f"""
    WITH RECURSIVE checked AS (
        SELECT *, CASE WHEN {crc} % 7 = 0 THEN 1 ELSE 0 END AS tampered FROM {documents}),
    hashed AS (SELECT doc_id, lang, sha256({leaf}) AS leaf, sha256({changed}) AS changed FROM checked),
    trees AS (
        SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
        FROM hashed GROUP BY lang),
    leaves AS (
        SELECT row_number() OVER () AS row, doc_id, leaf, changed, tree, n,
            row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM hashed JOIN trees ON hashed.lang IS NOT DISTINCT FROM trees.lang),
    below AS (
        SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT tree, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
        FROM below WHERE n > 1 GROUP BY tree, level, pos // 2),
    subroots AS (SELECT tree, level, digest FROM below WHERE n = 1),
    above AS (
        SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, digest FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
        FROM above WHERE n > 1 GROUP BY level, pos // 2),
    nodes AS (
        SELECT tree, level, pos, digest FROM below
        UNION ALL
        SELECT subroots.tree, subroots.level + above.level, above.pos + 1000000000000, above.digest
        FROM above, subroots),
    climb AS (
        SELECT row, tree, 0 AS step, pos, n, changed AS folded, '' AS proof, false AS up FROM leaves
        UNION ALL
        SELECT * FROM (
            SELECT row, moved.tree, moved.step + 1, moved.pos // 2, (n + 1) // 2,
                CASE WHEN moved.pos % 2 = 1 THEN sha256(coalesce(digest, '') || folded)
                    ELSE sha256(folded || coalesce(digest, '')) END,
                proof || coalesce(digest, ''), up
            FROM (SELECT row, tree, step, CASE WHEN up OR n > 1 THEN pos ELSE tree END AS pos,
                    CASE WHEN up OR n > 1 THEN n ELSE (SELECT count(*) FROM subroots) END AS n,
                    folded, proof, up OR n = 1 AS up FROM climb WHERE n > 1 OR NOT up) moved
            LEFT JOIN nodes ON nodes.tree = moved.tree AND nodes.level = moved.step
                AND nodes.pos = xor(moved.pos, 1) + CASE WHEN up THEN 1000000000000 ELSE 0 END
            WHERE moved.n > 1)),
    ended AS (SELECT row, arg_max(folded, step) AS folded, arg_max(proof, step) AS proof FROM climb GROUP BY row)
    SELECT doc_id, leaf, subroots.digest AS subroot, root.digest AS root, sha256(proof) AS proof_sha256,
        folded AS folded_root, folded = root.digest AS verified
    FROM leaves JOIN ended USING (row) JOIN subroots USING (tree), (SELECT digest FROM above WHERE n = 1) root"""


@register(merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(
        table(spark, sf_dir, "documents"),
        lambda: {"n_chars": merkle.added_one(F.col("doc_id"), F.col("n_chars"))},
    )


@register()
def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
