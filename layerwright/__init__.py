"""layerwright: DataFrame functions that carry raw files and SQL tables through a
landing, a base and a curated layer and end in a star schema with measures.

Every public function takes and returns ``pyspark.sql.DataFrame`` or ``Column``
objects; nothing here plans or executes a query itself.
"""
