"""Column expressions; all of them stay inside the JVM."""

from . import display, poisson, scores, text

__all__ = ["display", "poisson", "scores", "text"]
