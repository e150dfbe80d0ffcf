"""Training-data operators over document tables.

Each operator has its own module with a general interface; ``queries.py`` holds the thin
registered queries ``opN_<name>`` that apply it to the whole test tables, and
``corpus_pipeline.py`` at the repository top chains five of them.
"""
