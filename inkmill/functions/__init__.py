"""Part of inkmill; see README.md."""
