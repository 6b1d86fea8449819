"""quarry: corpus preparation, instruction-set building, tokenizer and
structured-output scoring as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or ``-> Column``);
named, runnable queries live in :mod:`quarry.plans`.
"""

__version__ = "0.1.0"
