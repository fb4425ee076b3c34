"""The stateless operators as SQL functions, so that Catalyst still sees plain expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from corpusmill.functions.chat import CHAT_ROLES, TURN_END, TURN_START


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _list(values: Sequence[str]) -> str:
    return ", ".join(_quoted(v) for v in values)


def register_sql(spark: SparkSession) -> None:
    """Create ``chunk_text(text, size)``, ``render_chat(messages)`` and
    ``assistant_mask(ids, header, end_id)`` for this session."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION chunk_text(body STRING, size INT)
        RETURNS ARRAY<STRING>
        RETURN filter(
            regexp_extract_all(body, concat('(?s).{1,', size, '}'), 0),
            piece -> piece rlike '(?U)[^\\\\s\\\\x1c-\\\\x1f]')
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION render_chat(
            messages ARRAY<STRUCT<role: STRING, content: STRING>>)
        RETURNS STRING
        RETURN array_join(
            transform(
                filter(messages, m -> m.role IN ({_list(CHAT_ROLES)})),
                m -> concat({_quoted(TURN_START)}, m.role, '\\n',
                            coalesce(m.content, ''), {_quoted(TURN_END)}, '\\n')),
            '')
        """
    )
    # A one-element transform binds a value to a name, so it is evaluated once.
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION assistant_mask(
            ids ARRAY<INT>, header ARRAY<INT>, end_id INT)
        RETURNS ARRAY<TINYINT>
        RETURN get(transform(
            array(struct(
                aggregate(
                    filter(
                        if(size(ids) >= size(header),
                           sequence(1, size(ids) - size(header) + 1), array()),
                        p -> ids[p - 1] = header[0] AND slice(ids, p, size(header)) = header),
                    CAST(array() AS ARRAY<INT>),
                    (kept, p) -> if(p >= coalesce(array_max(kept), 0),
                                    concat(kept, array(p + size(header))), kept)) AS starts,
                filter(transform(ids, (x, i) -> if(x = end_id, i + 1, NULL)),
                       e -> e IS NOT NULL) AS ends)),
            f -> get(transform(
                array(transform(f.starts,
                    s -> struct(s AS first, array_min(filter(f.ends, e -> e >= s)) AS last))),
                spans -> transform(ids, (x, i) -> CAST(
                    exists(spans, s -> coalesce(i + 1 BETWEEN s.first AND s.last, false))
                    AS TINYINT))), 0)), 0)
        """
    )
