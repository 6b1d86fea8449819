"""Operators for training-data pipelines at corpus scale.

One module per operator; ``queries`` registers ``opN_<name>`` and the pipeline.
Nothing outside this package imports it.
"""
