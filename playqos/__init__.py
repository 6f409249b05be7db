"""Video-playback quality-of-service lakehouse on PySpark.

Layers: raw files -> bronze (append-only reports) -> silver (keyed metrics)
-> dashboard queries. Every transform is ``DataFrame -> DataFrame``, so the same code
serves batch jobs and ``foreachBatch``. Transforms run no action, except where a size is
measured before a broadcast (``session.is_small``) and inside the streams' batch functions.

``playqos.llm`` holds operators for text corpora; nothing else imports it.
"""
