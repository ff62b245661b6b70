"""hirelens: cleaning, de-duplicating, scoring and reporting on job postings with Spark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark SQL expressions, joins and windows.  Python runs
inside tasks only for the two rules Spark has no built-in for: the
Ratcliff-Obershelp ratio (near-duplicate verification) and HTML parsing.
"""

from hirelens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
