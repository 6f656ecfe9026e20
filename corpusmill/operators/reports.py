"""Small result frames as Markdown or LaTeX. Only aggregates come to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cells(frame: DataFrame, most: int) -> tuple[list[str], list[list[str]]]:
    rows = frame.limit(most).collect()
    show = lambda v: f"{v:.4f}" if isinstance(v, float) else "" if v is None else str(v)
    return frame.columns, [[show(v) for v in r] for r in rows]


def markdown_table(frame: DataFrame, most: int = 1000) -> str:
    names, rows = _cells(frame, most)
    return "\n".join(["| " + " | ".join(r) + " |" for r in [names, ["---"] * len(names), *rows]])


def latex_table(frame: DataFrame, best: str, most: int = 100) -> str:
    """Rows by ``best`` from the top, the first one's value in bold."""
    names, rows = _cells(frame.orderBy(frame[best].desc(), names_first(frame)), most)
    at = names.index(best)
    for i, row in enumerate(rows):
        row[at] = rf"\textbf{{{row[at]}}}" if i == 0 else row[at]
    lines = [" & ".join(r).replace("_", r"\_") + r" \\" for r in [names, *rows]]
    return "\n".join([rf"\begin{{tabular}}{{{'l' * len(names)}}}", lines[0], r"\hline", *lines[1:], r"\end{tabular}"])


def names_first(frame: DataFrame):
    return frame[frame.columns[0]].asc()


def report(title: str, parts: dict[str, DataFrame]) -> str:
    """Headed sections of tables."""
    return "\n\n".join([f"# {title}", *(f"## {name}\n\n{markdown_table(f)}" for name, f in parts.items())]) + "\n"


def comparison_table(baseline: DataFrame, semantic: DataFrame, names: tuple[str, ...] = ("mean_rr", "mean_p_at_k", "mean_ndcg")) -> str:
    """LaTeX table of a keyword baseline against models (model, means), best mean reciprocal rank first."""
    rows = baseline.select(F.lit("keyword").alias("model"), *names).unionByName(semantic.select("model", *names))
    return latex_table(rows, names[0])


def difficulty_table(breakdown: DataFrame, score: str = "mean_rr") -> str:
    """LaTeX table of a breakdown by difficulty."""
    return latex_table(breakdown.select("difficulty", score), score)


def evaluation_report(pages: DataFrame, files: DataFrame, ready: DataFrame, temporal: DataFrame) -> str:
    """Report of one evaluation: pages by content type, files by type, readiness, freshness."""
    by_type = pages.groupBy("content_type").agg(F.count("*").alias("pages")).orderBy(F.desc("pages"), "content_type")
    return report("Evaluation", {"Pages by content type": by_type, "Files by type": files.orderBy("type"), "Readiness": ready, "Freshness": temporal})
