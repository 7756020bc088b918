"""Operators of training-data pipelines, one module each; nothing else imports this folder."""
