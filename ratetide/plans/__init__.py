"""Models (staging -> intermediate -> marts), the model graph and the DAG runner."""
