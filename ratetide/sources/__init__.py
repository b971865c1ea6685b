"""Landed-file readers (``files``) and the test-data bindings (``bindings``)."""
