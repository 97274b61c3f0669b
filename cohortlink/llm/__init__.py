"""Training-data operators: dedup, filtering, tokenizing and packing of text and vectors.

One module per operator (numbered as in the README), ``queries`` registers
them, ``corpus_pipeline.py`` at the repository top chains five of them.
Nothing outside this subpackage imports it.

Conventions shared by all operators:

* a null text counts as the empty text, a null id keeps its row;
* extra input columns never clash with work columns: every operator first
  projects the columns it needs (``common.narrow``);
* stage tables go to the folder named by ``spark.checkpoint.dir``
  (``common.materialise``), never to a machine-local folder on a cluster.
"""
