"""Learning-analytics features, risk scoring and monitoring as Spark DataFrame operators."""

KEYS = ["id_student", "code_module", "code_presentation"]
