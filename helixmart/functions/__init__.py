"""Column functions. Everything here maps ``Column`` to ``Column`` and stays inside Catalyst,
except the Arrow-batched part of :func:`helixmart.functions.text.lowercase_ascii`."""
