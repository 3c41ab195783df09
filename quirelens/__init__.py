"""quirelens: document-collection analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Names of the package and where they are; they are loaded on first use, so that executors and light users load little.
_HOME = {
    "AnnotationService": "plans.pipeline", "Pipeline": "plans.pipeline", "StageError": "plans.pipeline", "compare_backends": "plans.pipeline",
    "annotate": "operators.layout", "features": "operators.layout", "full_analysis": "operators.analytics", "all_reports": "operators.sinks",
    "question_set": "operators.sampling", "scan": "sources.annotations", "templates": "sources.annotations", "contents": "sources.documents",
    "listing": "sources.documents", "register": "sources.documents", "install": "sources.backends", "annotate_new": "streaming.incremental",
    "get_logger": "log", "set_log_level": "log", "CONTENT": "schema", "PROFILE": "schema", "ANNOTATION": "schema",
}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(name)
    import importlib

    return getattr(importlib.import_module(f"quirelens.{_HOME[name]}"), name)
