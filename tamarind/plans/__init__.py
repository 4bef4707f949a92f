"""Entity, staging, dimensional, mart, report and pipeline builders."""
