""
