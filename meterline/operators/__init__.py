"""DataFrame-to-DataFrame operators; unless noted, legal on static and streaming input."""
