"""stressframe.functions"""
